"""What keeps a lake whole: versions, ledger, sweeping, late rows, wide masks, texts of numbers."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contentlake.functions.numbers import plain_number, round_half_even
from contentlake.operators import manifest as m
from contentlake.operators import watermark as wm
from contentlake.operators.validate import annotate, error_rows, valid_rows, validation_report
from contentlake.plans.bronze import bronze_schema
from contentlake.plans.daily import Run, read_gold, run_daily
from contentlake.plans.silver import changed_since
from contentlake.session import tune
from contentlake.sources import ledger, versions
from contentlake.sources.files import child_names, create, exists, read_text
from contentlake.sources.state import COMMIT, committed_run, latest_version, read_commit, read_state, write_state
from contentlake.sources.tables import publish_table, read_published, read_silver, write_run
from contentlake.specs import VIDEO, DatasetSpec
from tests.test_daily import lake, production_row, video_row  # noqa: F401  (a fixture)


def test_unchanged_state_makes_no_version(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = spark.createDataFrame([(i, f"t{i}", ["a", None]) for i in range(50)], "x int, t string, l array<string>")
    assert write_state(spark, path, {"t": rows}, "r1") == 1
    assert write_state(spark, path, {"t": rows.orderBy(F.desc("x")).repartition(7)}, "r2") is None
    assert (latest_version(spark, path), committed_run(spark, path), child_names(spark, path)) == (1, "r1", ["v=1"])
    # One row more, one cell other, one row twice instead of another, another fact: all are changes.
    assert write_state(spark, path, {"t": rows.unionByName(rows.limit(1))}, "r3") == 2
    assert write_state(spark, path, {"t": rows.withColumn("t", F.expr("if(x = 3, 'other', t)"))}, "r4") == 3
    doubled = rows.filter("x <> 1").unionByName(rows.filter("x = 2"))
    assert write_state(spark, path, {"t": doubled}, "r5") == 4
    assert write_state(spark, path, {"t": doubled}, "r6", {"day": "2024-01-01"}) == 5
    assert write_state(spark, path, {"t": doubled}, "r7", {"day": "2024-01-01"}) is None
    assert read_commit(spark, path)["facts"] == {"day": "2024-01-01"}
    # Empty tables and no tables at all have a digest as well.
    assert write_state(spark, path, {"t": rows.limit(0)}, "r8") == 6
    assert write_state(spark, path, {"t": rows.filter("x > 99")}, "r9") is None
    assert read_state(spark, path, "t", "x int, t string, l array<string>").count() == 0


def test_half_written_table_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "gold")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    assert read_published(spark, path, "id bigint").count() == 0
    assert publish_table(spark, spark.range(3), path) == 1
    broken = spark.range(10, numPartitions=4).withColumn("id", F.expr("if(id = 9, raise_error('lost'), id)"))
    with pytest.raises(PySparkException):
        publish_table(spark, broken, path)
    # Some files of a writer that died are there, its marker is not.
    spark.range(7).write.parquet(f"{path}/v=3")
    (tmp_path / "gold" / "v=3" / "_SUCCESS").unlink()
    assert read_published(spark, path).count() == 3
    assert publish_table(spark, spark.range(5).withColumn("x", F.lit(1)), path, by="id") == 4
    assert read_published(spark, path).count() == 5
    assert versions.prune(spark, path, keep=2) in ([2, 3], [3])
    assert versions.versions(spark, path) == [1, 4] and read_published(spark, path).count() == 5
    publish_table(spark, spark.range(6), path)
    assert versions.prune(spark, path, keep=1) == [1, 4] and read_published(spark, path).count() == 6


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.newest(spark, path) is None and ledger.read_ledger(spark, path).count() == 0
    assert [ledger.record(spark, path, r, "t") for r in ("b", "a/1", "b")] == [1, 2, 1]
    assert ledger.finished(spark, path, "a/1") and not ledger.finished(spark, path, "a_1")
    assert ledger.newest(spark, path) == "a_2f_1"
    assert [tuple(r) for r in ledger.read_ledger(spark, path).orderBy("seq").collect()] == [(1, "b", "t"), (2, "a/1", "t")]
    name = f"{path}/{child_names(spark, path)[0]}"
    with pytest.raises(FileExistsError):
        create(spark, name, "other")
    assert "other" not in read_text(spark, name)


def test_old_runs_are_refused_and_scratch_shrinks(spark, lake):  # noqa: F811
    days = [{"one": [video_row(f"2024-01-0{d}", "shop", f"v{d}")]} for d in (5, 6, 7, 8, 9)]
    names = []
    for n, rows in enumerate(days):
        lake(n + 1, rows, [production_row("2024-01-01", "acc", "V1")], run_id=f"run {n}")
        run = Run(spark, lake.root, datetime(2024, 3, n + 1), f"run {n}")
        names.append(child_names(spark, run.scratch_root()))
    assert names == [[f"run_20_{n}"] for n in range(5)]
    with pytest.raises(ValueError, match="run 1"):
        lake(2, days[1], [], run_id="run 1")
    assert lake(5, days[4], [], run_id="run 4") == {}
    for path, marker in (("gold/fact_daily", versions.DONE), ("state/video", COMMIT)):
        assert len(versions.complete(spark, f"{lake.root}/{path}", marker)) == 3
    # Production brought nothing new after its first run, so its state has one version.
    assert versions.complete(spark, f"{lake.root}/state/produksi", COMMIT) == [1]
    assert read_gold(spark, lake.root).count() == 5
    assert [r["run_id"] for r in ledger.read_ledger(spark, f"{lake.root}/ledger").orderBy("seq").collect()] == [f"run {n}" for n in range(5)]


def test_a_run_that_died_before_gold_is_repeated(spark, lake, monkeypatch):  # noqa: F811
    import contentlake.plans.daily as daily

    one = {"one": [video_row("2024-01-05", "shop", "v1")]}
    lake(1, one, [])
    both = {"one": [*one["one"], video_row("2024-01-06", "shop", "v2", "12%"), video_row("2024-01-07", "shop", "v3")]}
    with monkeypatch.context() as patch:
        patch.setattr(daily, "publish_table", lambda *a, **k: (_ for _ in ()).throw(OSError("store gone")))
        with pytest.raises(OSError, match="store gone"):
            lake(2, both, [], run_id="second")
    assert read_gold(spark, lake.root).count() == 1
    assert not ledger.finished(spark, f"{lake.root}/ledger", "second")
    reports = lake(2, both, [], run_id="second")
    assert "video" not in reports  # its state was committed
    assert {r["action"]: r["n_rows"] for r in reports["merge_video"].collect()} == {"unchanged": 1}  # of the days from the last one merged
    assert read_gold(spark, lake.root).count() == 2
    assert spark.read.parquet(f"{lake.root}/bronze/video").count() == 2
    entries = read_state(spark, f"{lake.root}/state/video", "manifest", m.MANIFEST_SCHEMA).collect()
    assert [(r["error_date"], r["part"], r["bad_values"]) for r in entries] == [("2024-01-06", 0, ["12%"])]


def test_late_rows_of_the_marked_day(spark, tmp_path, lake):  # noqa: F811
    from tests.test_daily import VIDEO_HEADER, land
    from contentlake.plans.daily import Sheets
    from contentlake.sources.landing import read_landing

    first = [video_row("2024-01-05", "shop", "v1"), video_row("2024-01-06", "shop", "v2")]
    lake(1, {"one": first}, [])
    later = [*first, video_row("2024-01-06", "shop", "v3"), video_row("2024-01-05", "shop", "v4"), video_row("2024-01-07", "shop", "v5")]
    registry = spark.createDataFrame([("one", "c1", 0)], wm.REGISTRY_SCHEMA)
    sheets = {"video": Sheets(read_landing(spark, land(tmp_path, "late", {"one": later}, VIDEO_HEADER, 2)), registry)}
    run_daily(spark, lake.root, sheets, datetime(2024, 3, 2, 6), "late run", late=True)
    got = spark.read.parquet(f"{lake.root}/bronze/video").select("id_video", F.col("run_id") == "late run").collect()
    # v3 came late for the marked day; v4 is before it and lost; v2 was loaded and is not loaded again.
    assert sorted(map(tuple, got)) == [("v1", False), ("v2", False), ("v3", True), ("v5", True)]


def test_marked_day_filter(spark):
    ts = datetime
    rows = [(1, "a", ts(2024, 1, 5), "h1"), (2, "a", ts(2024, 1, 5, 9), "h2"), (3, "a", ts(2024, 1, 6), "h1"), (4, "a", ts(2024, 1, 4), "h4"),
            (5, "b", ts(2020, 1, 1), "h1"), (6, None, ts(2020, 1, 1), "h1"), (7, "a", None, "h7"), (8, "a", ts(2024, 1, 5), None), (9, "a", ts(2024, 1, 1), "h9")]
    df = spark.createDataFrame(rows, "id int, creds string, tanggal timestamp_ntz, row_hash_raw string")
    marks = spark.createDataFrame([("a", "2024-01-05"), ("e", "")], "creds string, mark string")
    loaded = spark.createDataFrame([("h1",), (None,), ("x",)], "row_hash_raw string")
    kept = wm.filter_marked_day(df, marks, loaded, bypass=F.col("id") == 9)
    assert sorted(r["id"] for r in kept.collect()) == [2, 3, 5, 6, 8, 9]
    assert wm.earliest_mark(marks) == "2024-01-05" and wm.earliest_mark(marks.limit(0)) is None
    plain = df.drop("creds")
    assert wm.filter_marked_day(plain, marks, loaded).count() == wm.filter_by_watermark(plain, marks).count() == len(rows)


def test_masks_of_seventy_columns(spark):
    names = tuple(f"c{i}" for i in range(70))
    spec = DatasetSpec(name="wide", header_row=0, id_column="id", date_columns=("day",), numeric_columns=names)
    bad = {3: "c0", 4: "c61", 5: "c62", 6: "c69"}
    rows = [(str(i), "2024-01-05", *["x!" if bad.get(i) == n else "1" for n in names]) for i in range(8)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in ("id", "day", *names)))
    flagged = annotate(df, spec)
    assert {r["id"] for r in error_rows(flagged, spec).select("id").collect()} == {str(i) for i in bad}
    report = validation_report(flagged, spec).first()
    assert report["affected_columns"] == ["c0", "c61", "c62", "c69"] and report["n_bad_rows"] == 4
    valid = valid_rows(flagged, spec)
    assert valid.columns == ["id", "day", *names] and valid.count() == 4


def test_number_text_does_not_depend_on_the_session(spark):
    cells = ["0", "12", "1.5", "-1.25", "100", "0.000000001", "-0.5", "99999999999999999999999999999.123456789", "7.100000000", None, "1e400"]
    want = ["0", "12", "1.5", "-1.25", "100", "0.000000001", "-0.5", "99999999999999999999999999999.123456789", "7.1", None, None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    whole = "0|2|2|4|null|0|-1".split("|")
    halves = spark.createDataFrame([(x,) for x in ("0.5", "1.5", "2.5", "3.5", "99999999999999999999", None, "-1.4")], "c string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            got = df.select(F.expr(plain_number("c")).alias("t"), F.expr(f"sha2({plain_number('c')}, 256)").alias("h")).collect()
            assert [r["t"] for r in got] == want, ansi
            rounded = halves.select(F.expr(round_half_even("CAST(c AS decimal(38,9))")).alias("n")).collect()
            assert ["null" if r["n"] is None else str(r["n"]) for r in rounded] == whole
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_merge_reads_recent_partitions_and_the_side_table(spark, lake):  # noqa: F811
    lake(1, {"one": [video_row("2024-01-05", "", "v1"), video_row("2024-01-05", "shop", "v2")]}, [])
    lake(2, {"one": [video_row("2024-01-06", "shop", "v3")]}, [])
    bronze, side = (spark.read.schema(bronze_schema(VIDEO)).parquet(f"{lake.root}/{t}/video") for t in ("bronze", "bronze_unmatched"))
    recent = changed_since(bronze, side, datetime(2024, 3, 2).date())
    assert sorted(r["id_video"] for r in recent.select("id_video").collect()) == ["v1", "v3"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(snapshot_date") == 2 and "isnull(toko" not in plan
    silver = spark.read.parquet(f"{lake.root}/silver/video").select("id_video").collect()
    assert sorted(r["id_video"] for r in silver) == ["V1", "V1", "V2", "V3"]  # the null shop is inserted again


def test_tables_without_a_source_column(spark):
    rows = [("one", datetime(2024, 1, 5), True), ("one", None, True), (None, datetime(2024, 1, 5), True)]
    df = spark.createDataFrame(rows, "sheet_name string, _date_0 timestamp_ntz, x boolean")
    for name, other in (("sheet_name", "creds"), ("creds", "sheet_name")):
        entries = m.manifest_entries(df.withColumnRenamed("sheet_name", name), F.array(F.lit("x")), "t", "p")
        got = sorted((r[name], r[other], r["error_date"], r["n_rows"]) for r in entries.collect())
        assert got == [("one", "one", "2024-01-05", 1), ("one", "one", "INVALID_DATE", 1)]


def test_commit_file_is_whole(spark, tmp_path):
    path = str(tmp_path / "s")
    write_state(spark, path, {"t": spark.range(2)}, "r")
    commit = json.loads(read_text(spark, f"{path}/v=1/{COMMIT}"))
    assert commit["run_id"] == "r" and commit["digests"]["t"][0] == "2"
    assert not exists(spark, f"{path}/v=1/.{COMMIT}.tmp")


def test_wide_rows_are_not_shuffled_to_be_dealt_out(spark, tmp_path):
    """Raw cells are made after the narrow rows were dealt out; rows from a shuffle are written as they are."""
    from checks import views

    spark.sql(
        "SELECT id AS event_id, TIMESTAMP'2024-01-05 10:00:00' AS ts, id AS user_id, 'view' AS event_type, 1D AS value, 'p' AS props"
        " FROM range(20)"
    ).write.parquet(f"{tmp_path}/events.parquet")
    raw = views.raw_video(spark, str(tmp_path))
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    at = next(line for line in plan.splitlines() if "Rebalance" in line)
    below = plan[plan.index(at) :]
    assert raw.count() == 20 and "CASE" not in below
    names = [line for line in raw._jdf.queryExecution().executedPlan().toString().splitlines() if "REBALANCE" in line]
    assert len(names) == 1


def test_first_run_has_nothing_to_meet(spark, tmp_path):
    """A table that is not there yet is known to be empty: no row is shuffled to be joined with it."""
    from contentlake.operators.watermark import REGISTRY_SCHEMA, STATE_SCHEMA, filter_by_watermark, watermark_map

    registry = spark.createDataFrame([("one", "c1", 0)], REGISTRY_SCHEMA)
    registry.write.parquet(str(tmp_path / "registry"))
    marks = watermark_map(read_state(spark, str(tmp_path / "state"), "w", STATE_SCHEMA), spark.read.parquet(str(tmp_path / "registry")))
    rows = spark.range(20).selectExpr("'c1' AS creds", "TIMESTAMP_NTZ'2024-01-05 10:00:00' AS tanggal", "id")
    kept = filter_by_watermark(rows, marks)
    assert kept.count() == 20 and "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    nothing = read_silver(spark, str(tmp_path / "silver"), "a string, b date")
    assert nothing.dtypes == [("a", "string"), ("b", "date")] and nothing.count() == 0
    assert read_published(spark, str(tmp_path / "gold"), "a string").count() == 0


def test_wide_tables_are_written_small_and_shuffles_dropped(spark, tmp_path):
    tune(spark, wide=True)
    write_run(spark.range(1000).selectExpr("sha2(CAST(id AS string), 256) AS h"), str(tmp_path / "t"), "20240101", "2024010106", "r", dealt=True)
    assert list(tmp_path.rglob("*.zstd.parquet")) and spark.read.parquet(str(tmp_path / "t")).select("h").distinct().count() == 1000
    again = spark.range(2000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(again.collect()) == sorted(again.collect())  # the shuffle is made again
