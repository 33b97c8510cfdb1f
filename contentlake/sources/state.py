"""Versioned run state: each commit is a new directory v=N holding all state tables.

A version counts once its commit file is there, and that one is written last. A run
that dies half-way leaves the previous version in force, for all tables at once, so the
same run can simply be started again.

The commit names the run, may hold a few facts, and has a digest of each table: the number of its
rows, and the exclusive or and the sum of their hashes, whatever their order. It is taken while the
table is written. A version that would equal the one in force is dropped again, so unchanged
state makes no version.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contentlake.functions.text import q
from contentlake.sources import versions
from contentlake.sources.files import create, exists, read_text, remove
from contentlake.sources.tables import empty_table

COMMIT = "commit.json"


def latest_version(spark: SparkSession, path: str) -> int | None:
    return versions.latest(spark, path, COMMIT)


def read_state(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """`table` as of the newest complete version; no state yet is an empty table."""
    v = latest_version(spark, path)
    if v is None or not exists(spark, f"{path}/v={v}/{table}"):
        return empty_table(spark, schema)
    return spark.read.schema(schema).parquet(f"{path}/v={v}/{table}")


def read_commit(spark: SparkSession, path: str) -> dict:
    """The newest commit: run_id, facts and digests; empty when there is none."""
    v = latest_version(spark, path)
    return json.loads(read_text(spark, f"{path}/v={v}/{COMMIT}")) if v is not None else {}


def committed_run(spark: SparkSession, path: str) -> str | None:
    """Run id of the newest complete version."""
    return read_commit(spark, path).get("run_id")


def write_digested(df: DataFrame, path: str) -> list[str]:
    """Write `df` and return its digest (rows, xor and sum of row hashes), in one job."""
    row = f"xxhash64({', '.join(q(c) for c in df.columns)})"
    seen = Observation()
    metrics = {"n": "count(1)", "x": f"bit_xor({row})", "s": f"sum(CAST({row} AS decimal(38,0)))"}
    df.observe(seen, *[F.expr(e).alias(n) for n, e in metrics.items()]).write.mode("errorifexists").parquet(path)
    return [str(seen.get[n]) for n in metrics]


def write_state(
    spark: SparkSession, path: str, tables: dict[str, DataFrame], run_id: str, facts: dict | None = None
) -> int | None:
    """Write the next version, its commit last, and return its number; None if nothing has changed."""
    before, v = read_commit(spark, path), versions.following(spark, path)
    digests = {name: write_digested(df, f"{path}/v={v}/{name}") for name, df in tables.items()}
    commit = {"run_id": run_id, "facts": facts or {}, "digests": digests}
    if before and all(before[k] == commit[k] for k in ("facts", "digests")):
        remove(spark, f"{path}/v={v}")
        return None
    create(spark, f"{path}/v={v}/{COMMIT}", json.dumps(commit))
    return v
