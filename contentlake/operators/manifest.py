"""Error manifest: open entries per (sheet_name, creds, error_date), their bad values,
and the proof that a key has recovered.

Bad values are found one distinct value per row. A key such as the rows without any readable
date may hold a third of all errors, so no aggregate ever gathers its values in one state: an
entry carries them as sorted arrays in parts of bounded size, a row per part. Part 0 is there
for every key and stands for it wherever keys are looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentlake.functions.dates import day_text, error_date
from contentlake.functions.text import MANIFEST_EMPTY_TOKENS, literal, q, strip
from contentlake.operators.validate import IS_ERROR, IS_VALID

KEY = ("sheet_name", "creds", "error_date")
OPEN, FIXED = "open", "fixed"
ENTRY_SCHEMA = (
    "sheet_name string, creds string, error_date string, affected_columns array<string>, "
    "n_rows bigint, reported_at string, path string, status string"
)
MANIFEST_SCHEMA = f"{ENTRY_SCHEMA}, part bigint, bad_values array<string>"
FIX_SCHEMA = (
    "sheet_name string, creds string, error_date string, affected_columns array<string>, "
    "resolved_at string, path string, status string"
)
PART_SIZE = 10_000


def _with_source(rows: DataFrame) -> DataFrame:
    """Rows that have both source columns; a table that lacks one takes the other for it."""
    have = [c for c in ("sheet_name", "creds") if c in rows.columns]
    if len(have) == 1:
        missing = "creds" if have == ["sheet_name"] else "sheet_name"
        rows = rows.withColumn(missing, F.col(have[0]))
    return rows


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with `error_date`, from the parsed primary date `_date_0`."""
    return _with_source(rows).withColumn("error_date", F.expr(error_date("_date_0"))).filter(
        F.col("sheet_name").isNotNull() & F.col("creds").isNotNull()
    )


def key_counts(annotated: DataFrame) -> DataFrame:
    """Error and valid rows per key in one pass: what entries and valid counts are taken from."""
    return _keyed(annotated.filter("NOT _blank")).groupBy(*KEY).agg(
        F.count_if(F.expr(IS_ERROR)).alias("n_rows"), F.count_if(F.expr(IS_VALID)).alias("n_valid")
    )


def entries_of(counts: DataFrame, affected: Column, reported_at: str, path: str) -> DataFrame:
    """One open entry per key of `counts` (key, n_rows) with errors."""
    return counts.filter("n_rows > 0").select(
        *KEY,
        affected.alias("affected_columns"),
        "n_rows",
        F.lit(reported_at).alias("reported_at"),
        F.lit(path).alias("path"),
        F.lit(OPEN).alias("status"),
    )


def manifest_entries(
    errors: DataFrame, affected: Column, reported_at: str, path: str
) -> DataFrame:
    """One open entry per key. `affected` is the batch-wide list of affected columns."""
    counts = _keyed(errors).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    return entries_of(counts, affected, reported_at, path)


def with_values(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """Entries with their bad values, a row per part; a key without any has an empty part 0."""
    none = F.array().cast("array<string>")
    return entries.join(parts, list(KEY), "left").withColumns(
        {"part": F.coalesce("part", F.lit(0)).cast("bigint"), "bad_values": F.coalesce("bad_values", none)}
    )


def heads(entries: DataFrame) -> DataFrame:
    """One row per key: part 0, without the values."""
    return entries.filter("part = 0").drop("part", "bad_values") if "part" in entries.columns else entries


def bad_values(errors: DataFrame, candidates: list[str], affected: Column) -> DataFrame:
    """Distinct non-empty values each key holds in the affected columns.

    `candidates` are the columns that could be affected at all; `affected` picks the
    ones that are.
    """
    cells = F.explode(
        F.array(
            *[
                F.expr(f"named_struct('name', {literal(c)}, 'value', {strip(q(c))})")
                for c in candidates
            ]
        )
    )
    return (
        _keyed(errors)
        .select(*KEY, cells.alias("cell"))
        .filter(
            F.array_contains(affected, F.col("cell.name"))
            & F.col("cell.value").isNotNull()
            & ~F.lower("cell.value").isin(*MANIFEST_EMPTY_TOKENS)
        )
        .select(*KEY, F.col("cell.value").alias("bad_value"))
        .distinct()
    )


def bad_value_parts(
    values: DataFrame, stage: Callable[[DataFrame], DataFrame], part_size: int = PART_SIZE
) -> DataFrame:
    """Sorted arrays of bad values, (key, part, bad_values): part k holds the values of rank
    k x `part_size` and up, so the parts in order are the sorted list.

    The ranks come from one sort by ranges of (key, value), whose cut points Spark takes from a sample of the
    values: a hot key lies in as many ranges as its values fill. A value's rank is its place in its
    range plus what the ranges before hold of its key. `stage` writes the sorted values and
    reads them back, so that both readers see the same places.
    """
    order = [*KEY, "bad_value"]
    in_order = values.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(in_order.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_at", 33))
    sizes = placed.groupBy(*KEY, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*KEY).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    return (
        placed.join(starts, [*KEY, "_range"])
        .select(*KEY, F.floor(rank / F.lit(part_size)).alias("part"), "bad_value")
        .groupBy(*KEY, "part")
        .agg(F.array_sort(F.collect_list("bad_value")).alias("bad_values"))
    )


def valid_counts(valid: DataFrame, date: str) -> DataFrame:
    """Valid rows per (sheet_name, creds, day)."""
    return valid.groupBy("sheet_name", "creds", F.expr(day_text(q(date))).alias("error_date")).agg(
        F.count(F.lit(1)).alias("n_valid")
    )


def confirmed_keys(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidate keys that now have exactly `n_rows` > 0 valid rows."""
    return (
        candidates.join(counts, list(KEY))
        .filter((F.col("n_rows") > 0) & (F.col("n_valid") == F.col("n_rows")))
        .select(*KEY)
    )


@dataclass(frozen=True)
class ManifestSync:
    remaining: DataFrame
    resolved: DataFrame
    fixes: DataFrame


def classify_open(open_entries: DataFrame, entries: DataFrame, counts: DataFrame) -> DataFrame:
    """Open entries with `outcome`: refreshed (seen again), resolved (recovered), kept."""
    seen = heads(entries).select(*KEY).withColumn("_seen", F.lit(True))
    proven = (F.col("n_rows") > 0) & (F.col("n_valid") == F.col("n_rows"))
    outcome = F.when(F.col("_seen"), "refreshed").when(proven, "resolved").otherwise("kept")
    return (
        open_entries.join(seen, list(KEY), "left")
        .join(counts.select(*KEY, "n_valid"), list(KEY), "left")
        .withColumn("outcome", outcome)
        .drop("_seen", "n_valid")
    )


def sync_manifest(
    open_entries: DataFrame, entries: DataFrame, counts: DataFrame, now: str
) -> ManifestSync:
    """This run's entries win, unproven old ones stay open, recovered ones leave.

    Entries may carry their values (both or neither of `open_entries` and `entries`).
    """
    classified = classify_open(open_entries, entries, counts)
    kept = classified.filter("outcome = 'kept'").drop("outcome")
    resolved = heads(classified.filter("outcome = 'resolved'").drop("outcome"))
    fixes = resolved.select(
        *KEY,
        "affected_columns",
        F.lit(now).alias("resolved_at"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.lit(FIXED).alias("status"),
    )
    return ManifestSync(kept.unionByName(entries), resolved, fixes)


def flag_recovered(valid: DataFrame, resolved: DataFrame, date: str) -> DataFrame:
    """Valid rows with `is_recovered`: their key was resolved this run.

    One left join serves both paths, so the batch is read once.
    """
    keys = resolved.select(*[F.col(k).alias(f"_{k}") for k in KEY]).withColumn(
        "is_recovered", F.lit(True)
    )
    on = (
        (F.col("sheet_name") == F.col("_sheet_name"))
        & (F.col("creds") == F.col("_creds"))
        & (F.expr(day_text(q(date))) == F.col("_error_date"))
    )
    names = [q(c) for c in valid.columns]
    return valid.join(keys, on, "left").selectExpr(
        *names, "coalesce(is_recovered, false) AS is_recovered"
    )


def select_recovered(
    valid: DataFrame, resolved: DataFrame, counts: DataFrame, date: str
) -> DataFrame:
    """Rows of resolved keys whose count still equals the manifest's `n_rows`."""
    exact = resolved.join(confirmed_keys(resolved, counts), list(KEY), "left_semi")
    return flag_recovered(valid, exact, date).filter("is_recovered").drop("is_recovered")


def remainder(valid: DataFrame, resolved: DataFrame, counts: DataFrame, date: str) -> DataFrame:
    """All other valid rows: they go through the watermark filter."""
    exact = resolved.join(confirmed_keys(resolved, counts), list(KEY), "left_semi")
    return flag_recovered(valid, exact, date).filter("NOT is_recovered").drop("is_recovered")


def recovery_counters(resolved: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: resolved keys, recovered rows, keys with another count, keys gone."""
    return with_counts(resolved, counts).selectExpr(*[f"{e} AS {n}" for n, e in RECOVERY_METRICS.items()])


RECOVERY_METRICS = {
    "recovery_resolved": "count(1)",
    "recovery_recovered_rows": "coalesce(sum(if(n_valid = n_rows, n_valid, NULL)), 0)",
    "recovery_count_mismatch": "count_if(n_valid IS NOT NULL AND coalesce(n_valid <> n_rows, true))",
    "recovery_absent": "count_if(n_valid IS NULL)",
}


def with_counts(resolved: DataFrame, counts: DataFrame) -> DataFrame:
    return resolved.join(counts.select(*KEY, "n_valid"), list(KEY), "left")
