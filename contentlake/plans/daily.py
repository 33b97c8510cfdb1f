"""The daily job: sheets to bronze per dataset, then both silver merges, then gold.

Everything that several steps read is written once to the shared scratch folder, so each
step starts from stored columns, a lost executor costs one task, and no step repeats the
parsing. Counters are observed by the job that writes, none has a pass of its own. Data is
written before state, all state of a dataset is committed at once, and gold is replaced as a
whole; a failed run is repeated with the same `run_id` and gives the same tables. A run that
has finished is in the ledger: the newest is not run again, an older id is refused.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from contentlake.operators import manifest as m
from contentlake.operators import watermark as wm
from contentlake.operators.merge import PRODUCTION_MERGE, VIDEO_MERGE
from contentlake.operators.validate import (
    REPORT_SCHEMA,
    annotate,
    checked_cells,
    date_names,
    error_rows,
    report_metrics,
    rows_with_id,
    valid_rows,
)
from contentlake.plans.bronze import (
    bronze_schema,
    build_bronze,
    date_keys,
    first_rows,
    loadable,
    utc,
)
from contentlake.plans.gold import gold_fact
from contentlake.plans.silver import (
    SILVER_PRODUCTION_SCHEMA,
    SILVER_VIDEO_SCHEMA,
    changed_since,
    silver_production,
    silver_video,
)
from contentlake.session import tune
from contentlake.sources import ledger, versions
from contentlake.sources.files import child_names, folder_name, has_files, remove, scratch_dir
from contentlake.sources.landing import promote_headers
from contentlake.sources.state import COMMIT, committed_run, read_commit, read_state, write_state
from contentlake.sources.tables import (
    DAY,
    MONTH,
    append_run,
    empty_table,
    merge_upsert,
    publish_table,
    read_published,
    read_silver,
    read_table,
    run_folder,
    write_run,
)
from contentlake.specs import PRODUCTION, VIDEO, DatasetSpec

WATERMARKS, MANIFEST = "watermarks", "manifest"
GOLD = ("gold", "fact_daily")
RECOVERY_SCHEMA = ", ".join(f"{name} bigint" for name in m.RECOVERY_METRICS)
MERGE_SCHEMA = "action string, n_rows bigint"
# A row whose key is null matches nothing and is looked at by every merge.
MERGE_KEY = {VIDEO.name: "toko", PRODUCTION.name: "akun"}
# Production has a few rows a day over many years, video a few days with very many.
GRAIN = {VIDEO.name: DAY, PRODUCTION.name: MONTH}
KEEP_VERSIONS = 3


@dataclass(frozen=True)
class Sheets:
    """Landed cells of one dataset and the registry of its sheets."""

    cells: DataFrame
    registry: DataFrame


@dataclass(frozen=True)
class Run:
    spark: SparkSession
    root: str
    ts: datetime
    run_id: str

    @property
    def now(self) -> str:
        return utc(self.ts).replace(tzinfo=None).isoformat()

    @property
    def day(self) -> date:
        return utc(self.ts).date()

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def scratch_root(self) -> str:
        base = scratch_dir(self.spark, self.path("_scratch"))
        lake = hashlib.sha256(self.root.encode()).hexdigest()[:16]  # lakes may share the folder
        return f"{base}/lake-{lake}"

    def scratch(self, *parts: str) -> str:
        return "/".join((self.scratch_root(), folder_name(self.run_id), *parts))

    def stage(self, df: DataFrame, *parts: str) -> DataFrame:
        """Write once, read back by all later steps."""
        path = self.scratch(*parts)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def observed(self, df: DataFrame, metrics: dict[str, str], *parts: str) -> tuple[DataFrame, dict]:
        """`stage`, with aggregates over the rows taken while they are written."""
        seen = Observation()
        staged = self.stage(df.observe(seen, *[F.expr(e).alias(n) for n, e in metrics.items()]), *parts)
        return staged, seen.get


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def _errors(run: Run, spec: DatasetSpec, annotated: DataFrame, counts: DataFrame, affected: Column) -> DataFrame:
    """Writes this run's quarantine and bad values; returns its manifest entries with their values."""
    name, keys = spec.name, date_keys(run.ts)
    quarantine, values_path = run.path("quarantine", name), run.path("manifest_values", name)
    folder = run_folder(*keys, run.run_id)
    errors = error_rows(annotated, spec, keep_date=True)
    write_run(errors.drop("_date_0"), quarantine, *keys, run.run_id, dealt=True)
    cells = [*checked_cells(annotated, spec), *date_names(annotated, spec)]
    found = m.bad_values(errors, cells, affected)
    write_run(found, values_path, *keys, run.run_id, dealt=True)
    if has_files(run.spark, f"{values_path}/{folder}"):
        found = run.spark.read.schema(found.schema).parquet(f"{values_path}/{folder}")
    parts = m.bad_value_parts(found, lambda df: run.stage(df, name, "values"))
    entries = m.entries_of(counts, affected, run.now, f"{quarantine}/{folder}")
    return run.stage(m.with_values(entries, parts), name, "entries")


def run_dataset(run: Run, spec: DatasetSpec, sheets: Sheets, late: bool = False) -> DataFrame | None:
    """One dataset up to bronze; returns its one-row report, None if already committed."""
    spark, name = run.spark, spec.name
    state = run.path("state", name)
    if committed_run(spark, state) == run.run_id:
        return None
    date_key, run_key = date_keys(run.ts)

    raw = promote_headers(
        sheets.cells,
        sheets.registry,
        spec.header_row,
        stage=lambda heads: run.stage(heads, name, "headers"),
    )
    flagged = annotate(rows_with_id(raw, spec), spec)
    annotated, report = run.observed(flagged, report_metrics(flagged, spec), name, "annotated")
    primary = date_names(annotated, spec)[0]
    keys = {"n_entries": "count_if(n_rows > 0)"}
    counts, n_keys = run.observed(m.key_counts(annotated), keys, name, "counts")

    # Manifest: this run's entries against the open ones.
    if report["has_changes"]:
        entries = _errors(run, spec, annotated, counts, _names(report["affected_columns"]))
    else:
        entries = empty_table(spark, m.MANIFEST_SCHEMA)
    opened = read_state(spark, state, MANIFEST, m.MANIFEST_SCHEMA).filter(f"status = '{m.OPEN}'")
    valid_counts = counts.filter("n_valid > 0")
    sync = m.sync_manifest(opened, entries, valid_counts, run.now)
    resolved, recovery = run.observed(
        m.with_counts(sync.resolved, valid_counts), m.RECOVERY_METRICS, name, "resolved"
    )

    # Bronze batch: recovered rows in any case, others past the mark of their sheet.
    marks_state = read_state(spark, state, WATERMARKS, wm.STATE_SCHEMA)
    marks = wm.watermark_map(marks_state, sheets.registry)
    valid = valid_rows(annotated, spec)
    if recovery["recovery_resolved"]:
        valid = m.flag_recovered(valid, resolved, primary)
    else:
        valid = valid.withColumn("is_recovered", F.lit(False))
    bronze = build_bronze(valid, spec, run.ts, run.run_id)
    loaded = _marked_days(run, spec, marks) if late else None
    unmatched = f"{MERGE_KEY[name]} IS NULL"
    passed = loadable(bronze, marks, loaded)
    if late:
        passed = run.stage(passed, name, "late")  # compared with bronze once
    # Only what counters and marks are taken from is staged; the rows themselves are made where they are written.
    narrow = passed.select("creds", "tanggal", "is_recovered", F.expr(unmatched).alias("unmatched"))
    dated, seen = run.observed(narrow, {"n": "count(1)", "n_unmatched": "count_if(unmatched)"}, name, "passed")

    if seen["n"]:
        landed = run.path("landed", name)
        write_run(first_rows(passed), landed, date_key, run_key, run.run_id, dealt=True)
        batch = spark.read.parquet(f"{landed}/{run_folder(date_key, run_key, run.run_id)}")
        # The stamps are the run's, stated once more: known to be constant, they cost no sort by partition.
        stamps = {"snapshot_date": F.lit(run.day), "run_id": F.lit(run.run_id)}
        append_run(batch.withColumns(stamps), run.path("bronze", name), dealt=True)
        if seen["n_unmatched"]:
            append_run(batch.filter(unmatched), run.path("bronze_unmatched", name))
    if recovery["recovery_resolved"]:
        write_run(sync.fixes, run.path("fixes", name), date_key, run_key, run.run_id)

    tables = {WATERMARKS: marks_state, MANIFEST: sync.remaining}
    if seen["n"]:
        fresh = wm.max_dates(dated.filter("NOT is_recovered"))
        updated = wm.update_watermarks(marks_state, fresh, sheets.registry, run.now)
        tables[WATERMARKS] = updated.withColumn("ord", F.lit(0).cast("bigint"))
    write_state(spark, state, tables, run.run_id)

    values = [*report.values(), *recovery.values(), n_keys["n_entries"]]
    return spark.createDataFrame([tuple(values)], f"{REPORT_SCHEMA}, {RECOVERY_SCHEMA}, n_manifest_entries bigint")


def _marked_days(run: Run, spec: DatasetSpec, marks: DataFrame) -> DataFrame | None:
    """Hashes of the bronze rows from the earliest mark on; None when there is no bronze or no mark yet."""
    path = run.path("bronze", spec.name)
    first = wm.earliest_mark(marks) if has_files(run.spark, path) else None
    if first is None:
        return None
    since = F.lit(first).try_cast("timestamp_ntz")
    return read_table(run.spark, path, bronze_schema(spec)).filter(F.col("tanggal") >= since).select("row_hash_raw")


def _merge(run: Run, spec: DatasetSpec, null_safe: bool) -> DataFrame | None:
    spark, name = run.spark, spec.name
    bronze_path, state = run.path("bronze", name), run.path("state", f"silver_{name}")
    if not has_files(spark, bronze_path):
        return None
    done = read_commit(spark, state).get("facts", {}).get("snapshot_date")
    since = min(date.fromisoformat(done), run.day) if done else None

    is_video = spec is VIDEO
    schema, unmatched_path = bronze_schema(spec), run.path("bronze_unmatched", name)
    has_unmatched = has_files(spark, unmatched_path)
    unmatched = read_table(spark, unmatched_path, schema) if has_unmatched else empty_table(spark, schema)
    recent = changed_since(read_table(spark, bronze_path, schema), unmatched, since)
    actions = merge_upsert(
        spark,
        run.path("silver", name),
        silver_video(recent) if is_video else silver_production(recent),
        VIDEO_MERGE if is_video else PRODUCTION_MERGE,
        run.scratch(f"silver_{name}"),
        SILVER_VIDEO_SCHEMA if is_video else SILVER_PRODUCTION_SCHEMA,
        null_safe,
        GRAIN[name],
    )
    newest = max(done or "", run.day.isoformat())
    write_state(spark, state, {}, run.run_id, {"snapshot_date": newest})
    return spark.createDataFrame(list(actions.items()), MERGE_SCHEMA)


def sweep(run: Run, keep_versions: int = KEEP_VERSIONS) -> None:
    """Drop the scratch of all other runs of the lake, and all but the newest versions of state and gold.

    For the end of a run, when nothing reads what earlier ones staged; a reader of an old version
    of gold has as many runs' time as versions are kept.
    """
    own = folder_name(run.run_id)
    for name in child_names(run.spark, run.scratch_root()):
        if name != own:
            remove(run.spark, f"{run.scratch_root()}/{name}")
    for name in child_names(run.spark, run.path("state")):
        versions.prune(run.spark, run.path("state", name), keep_versions, COMMIT)
    versions.prune(run.spark, run.path(*GOLD), keep_versions)


def run_daily(
    spark: SparkSession,
    root: str,
    sheets: dict[str, Sheets],
    run_ts: datetime,
    run_id: str,
    null_safe: bool = False,
    late: bool = False,
    keep_versions: int = KEEP_VERSIONS,
) -> dict[str, DataFrame]:
    """The whole chain. Returns the reports: `<dataset>` and `merge_<dataset>`.

    null_safe: null shops and accounts match each other. late: rows that arrive for the marked day
    are loaded, unless a row with their hash was. A run that is the newest in the ledger does nothing
    and returns no reports; the id of an older one is an error.
    """
    run = Run(tune(spark, wide=True), root, run_ts, run_id)
    book = run.path("ledger")
    if ledger.finished(spark, book, run_id):
        if ledger.newest(spark, book) != folder_name(run_id):
            raise ValueError(f"run {run_id!r} finished before the newest run of this lake")
        return {}


    def load(spec: DatasetSpec) -> tuple[DataFrame | None, DataFrame | None]:
        report = run_dataset(run, spec, sheets[spec.name], late) if spec.name in sheets else None
        return report, _merge(run, spec, null_safe)

    # The datasets share nothing before gold, and most of a step is waiting: each has a thread of jobs.
    specs = (VIDEO, PRODUCTION)
    with ThreadPoolExecutor(len(specs)) as pool:
        reports = list(pool.map(inheritable_thread_target(spark)(load), specs))
    out = {spec.name: report for spec, (report, _) in zip(specs, reports)}
    out |= {f"merge_{spec.name}": merged for spec, (_, merged) in zip(specs, reports)}

    video = read_silver(spark, run.path("silver", VIDEO.name), SILVER_VIDEO_SCHEMA)
    production = read_silver(
        spark, run.path("silver", PRODUCTION.name), SILVER_PRODUCTION_SCHEMA
    )
    publish_table(spark, gold_fact(video, production), run.path(*GOLD), by="tanggal")
    ledger.record(spark, book, run_id, run.now)
    sweep(run, keep_versions)
    return {k: df for k, df in out.items() if df is not None}


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    return read_published(spark, "/".join((root, *GOLD)))
