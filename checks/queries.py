"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from contentlake.functions.dates import excel_serial_date, parse_mixed_dates
from contentlake.functions.hashes import row_hash
from contentlake.functions.numbers import (
    MONEY,
    clean_number,
    is_numeric_corrupt,
    is_percent_corrupt,
    percent_to_fraction,
    round_half_even,
    safe_double,
    safe_long,
    safe_money,
)
from contentlake.functions.text import empty_to_null, literal, q, snake_case, strip, upper_trim
from contentlake.operators import manifest as m
from contentlake.operators import validate as val
from contentlake.operators import watermark as wm
from contentlake.operators.latest import (
    first_by_hash,
    latest_production,
    latest_video,
    production_dedup,
)
from contentlake.operators.merge import PRODUCTION_MERGE, VIDEO_MERGE, merge_actions, merge_plan
from contentlake.operators.naming import (
    drop_columns,
    row_counts,
    snake_case_columns,
    tag_sources,
    union_sheets,
)
from contentlake.plans.bronze import bronze_batch, bronze_schema, build_bronze
from contentlake.plans.daily import MANIFEST, WATERMARKS, read_gold
from contentlake.plans.gold import gold_fact
from contentlake.plans.silver import (
    SILVER_PRODUCTION_SCHEMA,
    SILVER_VIDEO_SCHEMA,
    silver_production_base,
    silver_video_base,
)
from contentlake.session import tune
from contentlake.sources.landing import promote_headers
from contentlake.sources.state import read_state
from contentlake.sources.tables import read_silver, read_table
from contentlake.specs import PRODUCTION, SILVER_PRODUCTION_KEYS, SILVER_VIDEO_KEYS, VIDEO

REPORTED_AT, PATH = "2024-02-01T06:00:00", "quarantine/video"
PART_SIZE = 100  # small, so that most keys have several parts
OUTCOME = f"CASE WHEN _blank THEN 'blank' WHEN {val.IS_ERROR} THEN 'error' ELSE 'valid' END AS outcome"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark, wide=True), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def _video(spark, sf) -> DataFrame:
    return v.sheet_rows(spark, sf, VIDEO)


def _annotated(spark, sf) -> DataFrame:
    return v.staged_annotated(spark, sf, VIDEO)


def _valid(spark, sf) -> DataFrame:
    return val.valid_rows(_annotated(spark, sf), VIDEO)


def _errors(spark, sf) -> DataFrame:
    return val.error_rows(_annotated(spark, sf), VIDEO, keep_date=True)


def _affected(spark, sf):
    """Batch-wide affected columns as a scalar subquery: nothing is collected."""
    return val.affected_list(_annotated(spark, sf), VIDEO).scalar()


def _counts(spark, sf) -> DataFrame:
    return m.valid_counts(_valid(spark, sf), "Tanggal")


def _entries(spark, sf) -> DataFrame:
    entries = m.manifest_entries(_errors(spark, sf), _affected(spark, sf), REPORTED_AT, PATH)
    return m.with_values(entries, _parts(spark, sf))


def _values(spark, sf) -> DataFrame:
    a = _annotated(spark, sf)
    cells = [*val.checked_cells(a, VIDEO), *val.date_names(a, VIDEO)]
    return m.bad_values(_errors(spark, sf), cells, _affected(spark, sf))


def _parts(spark, sf) -> DataFrame:
    def stage(values):
        return v.staged(spark, sf, "sorted_values", lambda: values, hint=None)

    return m.bad_value_parts(_values(spark, sf), stage, PART_SIZE)


def _open(spark, sf) -> DataFrame:
    """Open entries from an earlier run: one per key that has valid rows today, a third of
    them with another count, and one without a readable date per source, with values in two parts."""
    counts = _counts(spark, sf)
    dated = counts.select(
        *m.KEY, (F.col("n_valid") + (F.col("n_valid") % 3 == 0).cast("int")).alias("n_rows")
    )
    undated = counts.groupBy("sheet_name", "creds").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "sheet_name", "creds", F.lit("INVALID_DATE").alias("error_date"), "n_rows"
    )
    first, second = F.array(F.lit("a"), F.lit("b")), F.array(F.lit("c"))
    parts = F.when(F.col("error_date") == "INVALID_DATE", F.array(first, second)).otherwise(F.array(first))
    return dated.unionByName(undated).select(
        *m.KEY,
        F.array(F.lit("VV")).alias("affected_columns"),
        "n_rows",
        F.lit("2024-01-31T06:00:00").alias("reported_at"),
        F.lit("old").alias("path"),
        F.lit("open").alias("status"),
        F.posexplode(parts).alias("part", "bad_values"),
    ).withColumn("part", F.col("part").cast("bigint"))


def _sync(spark, sf) -> m.ManifestSync:
    return m.sync_manifest(
        _open(spark, sf), _entries(spark, sf), _counts(spark, sf), REPORTED_AT
    )


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "|") for c in ("affected_columns", "bad_values") if c in df.columns})


# --- Scalar functions -----------------------------------------------------------------


@query
def parse_mixed_dates_(spark, sf):
    return _video(spark, sf).select(
        "row_idx",
        F.expr(parse_mixed_dates("Tanggal")).alias("tanggal"),
        F.expr(parse_mixed_dates("Waktu")).alias("waktu"),
    )


@query
def date_parse_failures(spark, sf):
    return val.unparsable_dates(_video(spark, sf), "Tanggal")


@query
def parse_mixed_days(spark, sf):
    return _video(spark, sf).select(
        "row_idx", *[F.expr(parse_mixed_dates(c, as_date=True)).alias(snake_case(c)) for c in ("Tanggal", "Waktu")]
    )


@query
def excel_serial_date_(spark, sf):
    return _video(spark, sf).select(
        "row_idx", F.expr(excel_serial_date("Tanggal")).alias("serial_date")
    )


@query
def clean_numeric(spark, sf):
    return _video(spark, sf).select(
        "row_idx", *[F.expr(clean_number(q(c))).alias(snake_case(c)) for c in VIDEO.numeric_columns]
    )


@query
def percent_to_fraction_(spark, sf):
    return _video(spark, sf).select(
        "row_idx",
        *[F.expr(percent_to_fraction(q(c))).alias(snake_case(c)) for c in VIDEO.percent_columns],
    )


@query
def safe_casts(spark, sf):
    return _video(spark, sf).select(
        "row_idx",
        F.expr(safe_long("VV")).alias("vv_long"),
        F.expr(safe_long("dibagikan")).alias("dibagikan_long"),
        F.expr(safe_money("VV")).alias("vv_money"),
        F.expr(safe_double("komentar")).alias("komentar_double"),
        F.expr(safe_double(q("Persentase video yang ditonton hingga selesai"))).alias("pct_double"),
    )


@query
def round_half_even_(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    half = f"CAST(l_quantity / 2 AS {MONEY})"
    return df.select(
        "l_orderkey",
        "l_linenumber",
        F.expr(round_half_even(half)).alias("half_quantity"),
        F.expr(round_half_even(f"CAST(l_extendedprice AS {MONEY})")).alias("price"),
    )


@query
def upper_trim_(spark, sf):
    return _video(spark, sf).select(
        "row_idx",
        F.expr(upper_trim("toko")).alias("toko"),
        F.expr(upper_trim("informasi_video")).alias("informasi_video"),
    )


@query
def strip_text_hash(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    return df.select(
        "doc_id",
        F.expr(f"length({strip('text')})").alias("n_chars_stripped"),
        F.expr(row_hash("lang", strip("text"))).alias("text_hash"),
    )


@query
def empty_to_null_(spark, sf):
    return _video(spark, sf).select(
        "row_idx", *[F.expr(empty_to_null(c)).alias(c) for c in VIDEO.text_columns]
    )


@query
def profile_integral(spark, sf):
    valid = _valid(spark, sf)
    return valid.agg(
        *[F.expr(val.is_integral(q(c))).alias(snake_case(c)) for c in VIDEO.numeric_columns]
    )


# --- Sheets ----------------------------------------------------------------------------


@query
def sheet_promote_header(spark, sf):
    cells = v.staged(spark, sf, "landed", lambda: v.from_sql(spark, sf, v.LANDED_SQL))
    registry = v.from_sql(spark, sf, v.SOURCES_SQL)
    def stage(heads):
        return v.staged(spark, sf, "headers", lambda: heads)

    return snake_case_columns(promote_headers(cells, registry, header_row=2, stage=stage))


@query
def tag_sources_(spark, sf):
    rows = _video(spark, sf).select("row_idx", "id_video", "sheet_name")
    return tag_sources(rows, v.from_sql(spark, sf, v.SOURCES_SQL))


@query
def union_sheets_(spark, sf):
    video = _video(spark, sf).select("row_idx", "toko", "produk", "sheet_name")
    production = v.sheet_rows(spark, sf, PRODUCTION).select("row_idx", "produk", "akun", "sheet_name")
    return union_sheets([video, production])


@query
def ingest_counts(spark, sf):
    return row_counts(_video(spark, sf))


@query
def snake_case_columns_(spark, sf):
    return snake_case_columns(_video(spark, sf))


@query
def drop_columns_(spark, sf):
    return drop_columns(snake_case_columns(_video(spark, sf)), VIDEO.drop_columns)


@query
def filter_id_present(spark, sf):
    return val.rows_with_id(_video(spark, sf), VIDEO).select("row_idx", "Tanggal")


# --- Validation --------------------------------------------------------------------------


@query
def blank_rows(spark, sf):
    df = v.from_sql(spark, sf, v.BLANK_SQL)
    return df.select("row_idx", F.expr(val.blank_row(df)).alias("is_blank"))


@query
def numeric_corruption(spark, sf):
    hit = [F.expr(f"if({is_numeric_corrupt(q(c))}, {literal(c)}, NULL)") for c in VIDEO.numeric_columns]
    return _video(spark, sf).select("row_idx", F.concat_ws("|", *hit).alias("columns"))


@query
def percent_corruption(spark, sf):
    hit = [F.expr(f"if({is_percent_corrupt(q(c))}, {literal(c)}, NULL)") for c in VIDEO.percent_columns]
    return _video(spark, sf).select("row_idx", F.concat_ws("|", *hit).alias("columns"))


@query
def date_errors(spark, sf):
    return v.annotated(spark, sf, VIDEO).selectExpr(
        "row_idx", f"{val.has_bit('_undated', 0)} AS bad_tanggal", f"{val.has_bit('_undated', 1)} AS bad_waktu"
    )


@query
def validate_split(spark, sf):
    return v.annotated(spark, sf, VIDEO).selectExpr("row_idx", OUTCOME)


@query
def validate_split_production(spark, sf):
    return v.annotated(spark, sf, PRODUCTION).selectExpr("row_idx", OUTCOME)


@query
def valid_rows(spark, sf):
    return snake_case_columns(val.valid_rows(v.annotated(spark, sf, VIDEO), VIDEO))


@query
def error_reason(spark, sf):
    return val.error_rows(v.annotated(spark, sf, VIDEO), VIDEO).select("row_idx", "error_reason")


@query
def quarantine_rows(spark, sf):
    return snake_case_columns(val.error_rows(_annotated(spark, sf), VIDEO))


@query
def quarantine_rows_production(spark, sf):
    return val.error_rows(v.staged_annotated(spark, sf, PRODUCTION), PRODUCTION)


@query
def validation_report(spark, sf):
    return _flat(val.validation_report(v.annotated(spark, sf, VIDEO), VIDEO))


@query
def validation_affected_dates(spark, sf):
    return val.affected_dates(_annotated(spark, sf))


# --- Manifest and recovery ---------------------------------------------------------------


@query
def manifest_entries(spark, sf):
    return _flat(_entries(spark, sf))


@query
def manifest_bad_values(spark, sf):
    return _values(spark, sf)


@query
def manifest_bad_value_parts(spark, sf):
    return _flat(_parts(spark, sf))


@query
def manifest_sync(spark, sf):
    return _flat(_sync(spark, sf).remaining)


@query
def manifest_fixes(spark, sf):
    return _flat(_sync(spark, sf).fixes)


@query
def manifest_json(spark, sf):
    """Entries to JSON text and back."""
    entries = _entries(spark, sf)
    text = entries.select(F.to_json(F.struct("*")).alias("json"))
    return _flat(text.select(F.from_json("json", m.MANIFEST_SCHEMA).alias("e")).select("e.*"))


@query
def recovery_confirmed(spark, sf):
    return m.confirmed_keys(m.heads(_open(spark, sf)), _counts(spark, sf))


@query
def recovery_select(spark, sf):
    rows = m.select_recovered(
        _valid(spark, sf), m.heads(_open(spark, sf)), _counts(spark, sf), "Tanggal"
    )
    return rows.select("row_idx", "sheet_name", "creds")


@query
def recovery_remainder(spark, sf):
    rows = m.remainder(_valid(spark, sf), m.heads(_open(spark, sf)), _counts(spark, sf), "Tanggal")
    return rows.select("row_idx", "sheet_name", "creds")


@query
def recovery_counters(spark, sf):
    return m.recovery_counters(m.heads(_open(spark, sf)), _counts(spark, sf))


# --- Watermarks ----------------------------------------------------------------------------


def _state(spark, sf) -> tuple[DataFrame, DataFrame]:
    return v.from_sql(spark, sf, v.STATE_SQL), v.from_sql(spark, sf, v.REGISTRY_SQL)


@query
def watermark_read_migrate(spark, sf):
    return wm.watermark_map(*_state(spark, sf))


@query
def watermark_update(spark, sf):
    state, registry = _state(spark, sf)
    fresh = v.from_sql(spark, sf, v.FRESH_SQL)
    return wm.update_watermarks(state, fresh, registry, "2024-02-01T06:00:00").orderBy("creds")


@query
def watermark_filter(spark, sf):
    valid = _valid(spark, sf).select("row_idx", "creds", "Tanggal")
    return wm.filter_by_watermark(
        valid, v.from_sql(spark, sf, v.MARKS_SQL), date="Tanggal"
    ).select("row_idx", "creds", F.col("Tanggal").alias("tanggal"))


@query
def watermark_max_dates(spark, sf):
    kept = wm.filter_by_watermark(
        _valid(spark, sf), v.from_sql(spark, sf, v.MARKS_SQL), date="Tanggal"
    )
    return wm.max_dates(kept, date="Tanggal")


@query
def watermark_marked_day(spark, sf):
    """The second run's rows, those of the marked day unless the first run had loaded them."""
    marks = v.from_sql(spark, sf, v.MARKS_SQL)
    loaded, fresh = v.bronze(spark, sf, VIDEO, (1,)), v.bronze(spark, sf, VIDEO, (2,))
    since = F.lit(wm.earliest_mark(marks)).try_cast("timestamp_ntz")
    return wm.filter_marked_day(fresh, marks, loaded.filter(F.col("tanggal") >= since)).select(
        "row_idx", "creds", "tanggal", "row_hash_raw"
    )


def _stamped(df: DataFrame) -> DataFrame:
    """`snapshot_ts` as UTC without a zone, whatever the session's zone."""
    zoneless = F.col("snapshot_ts").cast("timestamp_ntz")
    return df.withColumn("snapshot_ts", F.convert_timezone(None, F.lit("UTC"), zoneless))


# --- Bronze ----------------------------------------------------------------------------------


@query
def row_hash_raw_video(spark, sf):
    return v.bronze(spark, sf, VIDEO).select("row_idx", "run_id", "row_hash_raw")


@query
def row_hash_raw_production(spark, sf):
    return v.bronze(spark, sf, PRODUCTION).select("row_idx", "run_id", "row_hash_raw")


@query
def bronze_video(spark, sf):
    parts = [v.bronze_run(spark, sf, VIDEO, n) for n in (1, 2, 3)]
    return _stamped(union_sheets(parts))


@query
def bronze_production(spark, sf):
    parts = [v.bronze_run(spark, sf, PRODUCTION, n) for n in (1, 2, 3)]
    return _stamped(union_sheets(parts))


@query
def bronze_batch_(spark, sf):
    exact = m.confirmed_keys(m.heads(_open(spark, sf)), _counts(spark, sf))
    flagged = m.flag_recovered(_valid(spark, sf), exact, "Tanggal")
    rows = build_bronze(flagged, VIDEO, v.run_ts(1), "run0")
    return _stamped(bronze_batch(rows, v.from_sql(spark, sf, v.MARKS_SQL)))


@query
def dedupe_row_hash(spark, sf):
    rows = v.bronze(spark, sf, PRODUCTION)
    return first_by_hash(rows, [F.asc("run_id"), F.asc("row_idx")]).select(
        "row_hash_raw", "run_id", "row_idx"
    )


# --- Silver and gold ---------------------------------------------------------------------------


@query
def latest_video_(spark, sf):
    return _stamped(latest_video(v.bronze(spark, sf, VIDEO)))


@query
def latest_production_(spark, sf):
    return _stamped(latest_production(v.bronze(spark, sf, PRODUCTION)))


@query
def silver_video_base_(spark, sf):
    return _stamped(silver_video_base(latest_video(v.bronze(spark, sf, VIDEO))))


@query
def silver_production_base_(spark, sf):
    return _stamped(silver_production_base(latest_production(v.bronze(spark, sf, PRODUCTION))))


@query
def row_hash_clean_video(spark, sf):
    return v.silver_source(spark, sf, VIDEO).select(*SILVER_VIDEO_KEYS, "row_hash_clean")


@query
def row_hash_clean_production(spark, sf):
    return v.silver_source(spark, sf, PRODUCTION).select(
        *SILVER_PRODUCTION_KEYS, "row_hash_clean"
    )


def _merge_video(spark, sf) -> DataFrame:
    return merge_plan(
        v.silver_target(spark, sf, VIDEO), v.silver_source(spark, sf, VIDEO), VIDEO_MERGE
    )


def _merge_production(spark, sf) -> DataFrame:
    return merge_plan(
        v.silver_target(spark, sf, PRODUCTION),
        v.silver_source(spark, sf, PRODUCTION),
        PRODUCTION_MERGE,
    )


@query
def merge_video(spark, sf):
    return _stamped(_merge_video(spark, sf))


@query
def merge_production(spark, sf):
    return _stamped(_merge_production(spark, sf))


@query
def merge_actions_(spark, sf):
    named_actions = [
        merge_actions(plan).withColumn("table_name", F.lit(t))
        for t, plan in (
            ("video", _merge_video(spark, sf)),
            ("production", _merge_production(spark, sf)),
        )
    ]
    return union_sheets(named_actions)


@query
def production_dedup_(spark, sf):
    silver = v.silver_full(spark, sf, PRODUCTION)
    return _stamped(production_dedup(silver, ("akun", "row_hash_clean")))


@query
def gold_fact_(spark, sf):
    return gold_fact(v.silver_full(spark, sf, VIDEO), v.silver_full(spark, sf, PRODUCTION))


# --- The daily job: three runs from landed cells to gold -----------------------------------------


@query
def daily_job_bronze(spark, sf):
    root = v.job_lake(spark, sf)
    parts = [
        read_table(spark, f"{root}/bronze/{spec.name}", bronze_schema(spec)).select(
            F.lit(spec.name).alias("dataset"), "tanggal", "creds", "sheet_name", "snapshot_ts",
            "snapshot_date", "run_id", "row_hash_raw",
        )
        for spec in (VIDEO, PRODUCTION)
    ]
    return _stamped(union_sheets(parts))


@query
def daily_job_silver_video(spark, sf):
    return _stamped(read_silver(spark, f"{v.job_lake(spark, sf)}/silver/video", SILVER_VIDEO_SCHEMA))


@query
def daily_job_silver_production(spark, sf):
    path = f"{v.job_lake(spark, sf)}/silver/{PRODUCTION.name}"
    return _stamped(read_silver(spark, path, SILVER_PRODUCTION_SCHEMA))


@query
def daily_job_gold(spark, sf):
    return read_gold(spark, v.job_lake(spark, sf))


def _of_both(read: Callable[[str], DataFrame]) -> DataFrame:
    """What `read` makes of either dataset's name, with that name."""
    return union_sheets([read(spec.name).withColumn("dataset", F.lit(spec.name)) for spec in (VIDEO, PRODUCTION)])


def _run_table(spark, sf, table: str, *cols: str) -> DataFrame:
    """A table written by run: its columns and the keys of its folders."""
    keys = [F.col(k).cast("string").alias(k) for k in ("date", "run_key", "run")]
    root = v.job_lake(spark, sf)
    return _of_both(lambda name: read_table(spark, f"{root}/{table}/{name}").select(*cols, *keys))


@query
def daily_job_manifest(spark, sf):
    """Open entries after the last run; of a quarantine path the part below the lake."""
    root = v.job_lake(spark, sf)
    entries = _of_both(lambda name: read_state(spark, f"{root}/state/{name}", MANIFEST, m.MANIFEST_SCHEMA))
    return _flat(entries).withColumn("path", F.substring_index("path", "/quarantine/", -1))


@query
def daily_job_watermarks(spark, sf):
    root = v.job_lake(spark, sf)
    return _of_both(lambda name: read_state(spark, f"{root}/state/{name}", WATERMARKS, wm.STATE_SCHEMA)).drop("ord")


@query
def daily_job_quarantine(spark, sf):
    return _run_table(spark, sf, "quarantine", "row_idx", "sheet_name", "creds", "error_reason")


@query
def daily_job_values(spark, sf):
    return _run_table(spark, sf, "manifest_values", *m.KEY, "bad_value")


@query
def daily_job_landed(spark, sf):
    return _run_table(spark, sf, "landed", "tanggal", "creds", "row_hash_raw")


# Functions whose name is also the operator's carry a trailing underscore here only.
QUERIES = {name.rstrip("_"): fn for name, fn in QUERIES.items()}
