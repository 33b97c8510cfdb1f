"""Lake tables on plain parquet.

Writes hand Spark a rebalance hint on the partition column: rows of one partition go to
as few tasks as their size allows and a hot partition is split over several, so a day
with a third of all rows neither ends in one task nor in thousands of tiny files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contentlake.operators.merge import INSERT, KEEP, UNCHANGED, UPDATE, MergeSpec, merge_plan
from contentlake.sources import versions
from contentlake.sources.files import folder_name, has_files

_PART = "part_key"  # a name with a leading underscore would count as hidden
DAY, MONTH = "day", "month"


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, and Spark knows it: joins with it fall away. Rows of unknown number would be shuffled to meet it."""
    return spark.createDataFrame([], schema).filter("false")


def write_partitions(df: DataFrame, path: str, by: tuple[str, ...]) -> None:
    """Replace exactly the partitions `df` holds. Running it again changes nothing."""
    (
        df.write.partitionBy(*by)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def run_folder(date: str, run_key: str, run_id: str) -> str:
    """`date=YYYYMMDD/run_key=YYYYMMDDHH/run=...`: two runs within an hour keep apart."""
    return f"date={date}/run_key={run_key}/run={folder_name(run_id)}"


def write_run(df: DataFrame, path: str, date: str, run_key: str, run_id: str, dealt: bool = False) -> None:
    """Landing and quarantine layout of `run_folder`; the same run replaces its own rows.

    `dealt`: the rows come from a shuffle of their own, or from files read in pieces of bounded size, and are not
    shuffled again."""
    keys = {"date": date, "run_key": run_key, "run": folder_name(run_id)}
    keyed = df.withColumns({k: F.lit(v) for k, v in keys.items()})
    write_partitions(keyed if dealt else keyed.hint("rebalance"), path, tuple(keys))


def append_run(df: DataFrame, path: str, dealt: bool = False) -> None:
    """Append one run to a bronze table partitioned by snapshot day and run. The run
    owns its partition, so a repeated append of the same run does not double rows. `dealt` as in `write_run`."""
    write_partitions(df if dealt else df.hint("rebalance"), path, ("snapshot_date", "run_id"))


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def publish_table(spark: SparkSession, df: DataFrame, path: str, by: str | None = None) -> int:
    """Replace a table as a whole: a new version beside the old one, which readers see until it is complete."""
    v = versions.following(spark, path)
    hinted = df.hint("rebalance", by) if by else df.hint("rebalance")
    writer = hinted.write.mode("errorifexists")
    (writer.partitionBy(by) if by else writer).parquet(f"{path}/v={v}")
    return v


def read_published(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The newest complete version of a published table; empty (with a schema) when there is none."""
    v = versions.latest(spark, path)
    if v is None:
        if schema is None:
            raise FileNotFoundError(f"no complete version in {path}")
        return empty_table(spark, schema)
    return read_table(spark, f"{path}/v={v}", schema)


def read_silver(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Silver table without its partition column; empty when there is none yet."""
    if not has_files(spark, path):
        return empty_table(spark, schema)
    return spark.read.schema(f"{schema}, {_PART} date").parquet(path).drop(_PART)


def _part(grain: str) -> Column:
    day = F.to_date("tanggal")
    return day if grain == DAY else F.trunc(day, "month")


def merge_upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    spec: MergeSpec,
    staging: str,
    schema: str,
    null_safe: bool = False,
    grain: str = DAY,
) -> dict[str, int]:
    """Merge `source` into the silver table at `path`; returns rows per merge branch.

    The table is partitioned by `grain`: by day where a day holds much, by month where a table of few
    rows a day would fall into thousands of small files.

    1. `source` is written once: what follows reads it several times.
    2. Only target partitions that occur in the source are read (there are at most as many
       as days in the year window, so that list may be broadcast).
    3. The merged partitions are staged in full, their rows counted per branch in the same job; those
       in which something changed are swapped in by partition overwrite. The table is
       never overwritten while it is read, and a failed swap can be repeated.
    """
    source_path, merged_path = f"{staging}/source", f"{staging}/merged"
    source.withColumn(_PART, _part(grain)).write.mode("overwrite").parquet(source_path)
    with_part = f"{schema}, {_PART} date"
    staged = spark.read.schema(with_part).parquet(source_path)

    if has_files(spark, path):
        parts = F.broadcast(staged.select(_PART).distinct())
        target = spark.read.schema(with_part).parquet(path).join(parts, _PART, "left_semi")
    else:
        target = empty_table(spark, with_part)

    counted = Observation()
    branches = (INSERT, UPDATE, UNCHANGED, KEEP)
    plan = merge_plan(target.drop(_PART), staged.drop(_PART), spec, null_safe).withColumn(_PART, _part(grain))
    plan = plan.observe(counted, *[F.count_if(F.col("action") == b).alias(b) for b in branches])
    plan.write.mode("overwrite").parquet(merged_path)
    n_rows = {b: n for b, n in counted.get.items() if n}

    if n_rows.get(INSERT) or n_rows.get(UPDATE):
        result = spark.read.schema(f"{schema}, action string, {_PART} date").parquet(merged_path)
        # Partitions in which nothing changed are left as they are.
        changed = F.broadcast(result.filter(F.col("action").isin(INSERT, UPDATE)).select(_PART).distinct())
        swap = result.join(changed, _PART, "left_semi").drop("action")
        write_partitions(swap.hint("rebalance", _PART), path, (_PART,))
    return n_rows
