"""Operators on small fixtures: edge cases, exactness under skew, plan shape."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks import views as v
from contentlake.functions.numbers import is_numeric_corrupt
from contentlake.operators import manifest as m
from contentlake.operators import watermark as wm
from contentlake.operators.latest import first_by_hash, latest_per_key
from contentlake.operators.merge import MergeSpec, merge_actions, merge_plan
from contentlake.operators.naming import snake_case_columns
from contentlake.operators.skew import hot_keys, left_join_unique
from contentlake.sources.landing import LANDING_SCHEMA, promote_headers
from contentlake.sources.state import read_state, write_state
from contentlake.specs import PRODUCTION, VIDEO

SF_DIR = "/root/testdata/sf0.001"


def bag(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_watermark_filter(spark):
    ts = datetime
    df = spark.createDataFrame(
        [
            (1, "a", ts(2024, 1, 5)),
            (2, "a", ts(2024, 1, 5, 0, 1)),
            (3, "a", ts(2024, 1, 6)),
            (4, "a", None),
            (5, "b", ts(2020, 1, 1)),
            (6, "b", None),
            (7, None, ts(2020, 1, 1)),
            (8, "e", ts(2020, 1, 1)),
        ],
        "id int, creds string, tanggal timestamp_ntz",
    )
    marks = spark.createDataFrame([("a", "2024-01-05"), ("e", "")], "creds string, mark string")
    kept = wm.filter_by_watermark(df, marks)
    assert [r[0] for r in bag(kept, "id")] == [2, 3, 5, 6, 7, 8]
    assert bag(wm.max_dates(kept), "creds", "max_date") == [
        ("a", "2024-01-06"),
        ("b", "2020-01-01"),
        ("e", "2020-01-01"),
    ]
    again = wm.filter_by_watermark(df, marks, bypass=F.col("id") == 1)
    assert [r[0] for r in bag(again, "id")] == [1, 2, 3, 5, 6, 7, 8]
    whole_day = wm.filter_by_watermark(df, marks, inclusive=True)
    assert [r[0] for r in bag(whole_day, "id")] == [1, 2, 3, 5, 6, 7, 8]


MERGE = MergeSpec(
    columns=("tanggal", "toko", "id", "v", "row_hash_clean"),
    keys=("tanggal", "toko", "id"),
    exact_keys=("tanggal", "toko"),
    blank_keys=("id",),
)
MERGE_DDL = "tanggal string, toko string, id string, v int, row_hash_clean string"


def test_merge_cases(spark):
    target = spark.createDataFrame(
        [
            ("d", "A", "same", 1, "h"),
            ("d", "A", "new", 1, "h1"),
            ("d", "A", "nohash", 1, None),
            ("d", "A", "gone", 1, "h"),
            ("d", "A", None, 1, "h1"),
            ("d", None, "x", 1, "h"),
        ],
        MERGE_DDL,
    )
    source = spark.createDataFrame(
        [
            ("d", "A", "same", 2, "h"),
            ("d", "A", "new", 2, "h2"),
            ("d", "A", "nohash", 2, "h2"),
            ("d", "A", "", 2, "h2"),
            ("d", None, "x", 2, "h"),
            ("e", "A", "same", 2, "h"),
        ],
        MERGE_DDL,
    )
    plan = merge_plan(target, source, MERGE)
    assert bag(plan, "tanggal", "toko", "id", "v", "action") == sorted(
        [
            ("d", "A", "same", 1, "unchanged"),
            ("d", "A", "new", 2, "update"),
            ("d", "A", "nohash", 1, "unchanged"),
            ("d", "A", "gone", 1, "keep"),
            ("d", "A", None, 2, "update"),  # keys keep their target value
            ("d", None, "x", 1, "keep"),
            ("d", None, "x", 2, "insert"),  # a null shop matches nothing
            ("e", "A", "same", 2, "insert"),
        ],
        key=repr,
    )
    safe = merge_plan(target, source, MERGE, null_safe=True)
    assert dict(bag(merge_actions(safe), "action", "n_rows"))["insert"] == 1
    merged = plan.drop("action").filter("toko IS NOT NULL")
    again = merge_plan(merged, source.filter("toko IS NOT NULL"), MERGE)
    assert bag(again.drop("action"), *MERGE.columns) == bag(merged, *MERGE.columns)


def _entry(key, n_rows):
    return (*key, ["VV"], n_rows, "t0", "p0", "open")


def test_manifest_cases(spark):
    key = {n: ("s", "c", n) for n in ("refresh", "fixed", "more", "absent", "INVALID_DATE")}
    opened = spark.createDataFrame([_entry(k, 2) for k in key.values()], m.ENTRY_SCHEMA)
    entries = spark.createDataFrame(
        [(*key["refresh"], ["VV"], 1, "t1", "p1", "open"), ("s", "c", "brandnew", ["VV"], 1, "t1", "p1", "open")],
        m.ENTRY_SCHEMA,
    )
    counts = spark.createDataFrame(
        [(*key["fixed"], 2), (*key["more"], 3)],
        "sheet_name string, creds string, error_date string, n_valid bigint",
    )
    sync = m.sync_manifest(opened, entries, counts, "t1")
    assert bag(sync.remaining, "error_date", "n_rows", "reported_at") == [
        ("INVALID_DATE", 2, "t0"),
        ("absent", 2, "t0"),
        ("brandnew", 1, "t1"),
        ("more", 2, "t0"),
        ("refresh", 1, "t1"),
    ]
    assert bag(sync.fixes, "error_date", "path", "status") == [("fixed", "p0", "fixed")]
    counters = m.recovery_counters(opened, counts).first()
    assert tuple(counters) == (5, 2, 1, 3)


def test_bad_value_parts_are_the_sorted_list(spark, tmp_path):
    values = spark.range(1000).selectExpr(
        "'s' AS sheet_name", "'c' AS creds", "'INVALID_DATE' AS error_date", "CAST(id AS string) AS bad_value"
    )
    few = values.filter("bad_value < '12'").withColumn("creds", F.lit("other"))

    def stage(df):
        df.write.parquet(str(tmp_path / "sorted"))
        return spark.read.parquet(str(tmp_path / "sorted"))

    rows = m.bad_value_parts(values.unionByName(few).repartition(9), stage, part_size=100).collect()
    want = sorted(str(i) for i in range(1000))
    of = {r["part"]: r["bad_values"] for r in rows if r["creds"] == "c"}
    assert of == {k: want[100 * k : 100 * k + 100] for k in range(10)}
    assert [r["bad_values"] for r in rows if r["creds"] == "other"] == [[v for v in want if v < "12"]]


def test_join_is_exact_with_hot_and_null_keys(spark):
    left = spark.range(6000).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 AND id % 2 = 0 THEN NULL ELSE CAST(id AS string) END AS k",
    )
    right = spark.range(3000).selectExpr("CAST(id AS string) AS rk", "id * 10 AS v").unionByName(
        spark.createDataFrame([("hot", -1), (None, -2)], "rk string, v bigint")
    )
    assert bag(hot_keys(left, "k", max_hot=8, tracked=64, min_rows=10), "_hot") == [("hot",)]
    assert hot_keys(left, "k").isEmpty()  # too few rows to be worth a salt
    got = left_join_unique(left, right, "k", "rk", ["id"], fan_out=4, max_hot=8, tracked=64, min_rows=10)
    want = left.join(right, left.k == right.rk, "left")
    assert bag(got, "id", "k", "rk", "v") == bag(want, "id", "k", "rk", "v")


def test_promote_headers(spark):
    cells = spark.createDataFrame(
        [
            ("one", 0, ["A b", "", "A b"]),
            ("one", 1, ["1", "2", "3"]),
            ("one", 2, ["4"]),
            ("two", 0, ["C.", "A b"]),
            ("two", 1, ["5", "6"]),
        ],
        LANDING_SCHEMA,
    )
    registry = spark.createDataFrame([("one", "c1", 0), ("two", "c2", 1)], wm.REGISTRY_SCHEMA)
    df = promote_headers(cells, registry, header_row=0)
    assert df.columns[:3] == ["A b", "unnamed", "C."]
    assert bag(snake_case_columns(df), "a_b", "unnamed", "c", "creds", "row_idx") == [
        ("1", "2", None, "c1", 1),
        ("4", None, None, "c1", 2),
        ("6", None, "5", "c2", 1),
    ]


def test_promote_headers_spellings(spark):
    """Names equal once normalised are one column; in a sheet the first of them counts."""
    cells = spark.createDataFrame(
        [
            ("one", 0, ["Kode", "KODE", None]),
            ("one", 1, ["1", "2", "3"]),
            ("two", 0, ["x", "kode "]),
            ("two", 1, ["4", "5"]),
        ],
        LANDING_SCHEMA,
    )
    registry = spark.createDataFrame([("one", "c1", 0), ("two", "c2", 1)], wm.REGISTRY_SCHEMA)
    df = promote_headers(cells, registry, header_row=0)
    assert df.columns[:3] == ["Kode", "unnamed", "x"]
    assert bag(df, "Kode", "unnamed", "x") == [("1", "3", None), ("5", None, "4")]


def test_promote_headers_moves_no_cell(spark, tmp_path):
    """With the headers staged, cells beyond the broadcast threshold stay where they are."""
    rows = "SELECT 'one' AS sheet_name, id AS row_idx, array(uuid(), uuid()) AS cells FROM range(20000)"
    spark.sql(rows).write.parquet(str(tmp_path / "cells"))
    cells = spark.read.schema(LANDING_SCHEMA).parquet(str(tmp_path / "cells"))
    registry = spark.createDataFrame([("one", "c1", 0)], wm.REGISTRY_SCHEMA)

    def stage(heads):
        heads.write.parquet(str(tmp_path / "heads"))
        return spark.read.schema(heads.schema).parquet(str(tmp_path / "heads"))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        plan = plan_of(promote_headers(cells, registry, 0, stage=stage))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert plan.count("Scan parquet") == 2  # cells and staged headers


def test_state_versions(spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_state(spark, path, "t", "x int").count() == 0
    write_state(spark, path, {"t": spark.range(1).selectExpr("CAST(id AS int) AS x")}, "r1")
    # A version without its commit record does not count.
    spark.range(9).selectExpr("CAST(id AS int) AS x").write.parquet(f"{path}/v=2/t")
    assert read_state(spark, path, "t", "x int").count() == 1
    assert write_state(spark, path, {"t": spark.range(3).selectExpr("CAST(id AS int) AS x")}, "r3") == 3
    assert read_state(spark, path, "t", "x int").count() == 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    for name in ("validate_split", "bronze_video", "merge_video", "gold_fact", "manifest_sync", "watermark_filter"):
        plan = plan_of(queries()[name](spark, SF_DIR))
        for unwanted in ("Python", "Cartesian", "NestedLoop"):
            assert unwanted not in plan, (name, unwanted)
    for name in ("latest_video", "latest_production", "production_dedup", "dedupe_row_hash"):
        plan = plan_of(queries()[name](spark, SF_DIR))
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning")
        assert "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning") :]
    assert "BroadcastHashJoin" in plan_of(queries()["watermark_filter"](spark, SF_DIR))


def test_latest_row_of_keys_that_begin_alike(spark):
    """Null keys are one key, equal keys one row, and the sort is led by a hash of the keys."""
    rows = [("a", None, 1), ("a", None, 2), (None, "x", 3), (None, "x", 1), ("a", "x", 5), ("a", "x", 5), (None, None, 0)]
    df = spark.createDataFrame(rows, "k string, j string, n int")
    latest = latest_per_key(df, [F.upper("k"), F.col("j")], [F.desc("n")])
    assert bag(latest, "k", "j", "n") == sorted([("a", None, 2), (None, "x", 3), ("a", "x", 5), (None, None, 0)], key=repr)
    assert "xxhash64" in plan_of(latest)


def test_usual_cells_are_not_searched_for_large_numbers(spark):
    """The search for a number no bigint holds is in a branch; behind an AND Spark ran it for every cell."""
    cells = ["1.234", "Rp 5.000,50", "9" * 19, "9" * 18, "9" * 18 + ",55", "1" + "0" * 18, "12%", "", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string").selectExpr("c", f"{is_numeric_corrupt('c')} AS bad")
    assert [c for c, bad in df.collect() if bad] == ["9" * 19, "12%"]
    assert "CASE WHEN (length(c" in plan_of(df).replace("LocalTableScan", "")


def test_staged_files_are_read_in_pieces(spark):
    """One file of many rows is read by several tasks, each with some of its rows, and splits stay small."""
    rows = spark.range(400_000).repartition(1).selectExpr("id", "sha2(CAST(id AS string), 256) AS text")
    read = v.staged(spark, "own rows", "pieces", lambda: rows)
    assert read.select(F.spark_partition_id()).distinct().count() > 2
    assert read.count() == 400_000
    queries()["ingest_counts"](spark, SF_DIR)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "8m"


def test_rows_read_by_one_step_are_not_staged(spark, tmp_path):
    """Bronze and the flags are made of the tables themselves; a task gets a bounded number of rows."""
    for table in ("events", "orders"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").limit(60).write.parquet(f"{tmp_path}/{table}.parquet")
    for spec, table in ((VIDEO, "events"), (PRODUCTION, "orders")):
        for df in (v.annotated(spark, str(tmp_path), spec), v.bronze_run(spark, str(tmp_path), spec, 1)):
            assert all(f"/{table}.parquet/" in f for f in df.inputFiles())
    assert not any(sf == str(tmp_path) for _, sf, _ in v._STAGED)


def test_cells_are_made_once(spark):
    """A filter on made rows stays above them, with the same rows."""
    df = spark.range(20).select((F.col("id") * 3).alias("a.b"), F.concat(F.lit("x"), "id").alias("c"))
    made = v.made_once(df)
    assert made.columns == df.columns and made.dtypes == df.dtypes
    kept = made.filter("c LIKE '%1%'")
    assert bag(kept, "c") == bag(df.filter("c LIKE '%1%'"), "c")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate") < plan.index("concat(x")


def test_rows_of_a_task_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(v, "ROWS_A_TASK", 20)
    rows = v.raw_video(spark, SF_DIR)
    n, parts = rows.count(), rows.groupBy(F.spark_partition_id().alias("p")).count()
    assert n > 800 and max(r["count"] for r in parts.collect()) <= 60


def test_first_by_hash_shuffles_one_hash(spark):
    rows = spark.createDataFrame(
        [("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 3)], "row_hash_raw string, row_idx int"
    )
    first = first_by_hash(rows, [F.asc("row_idx")])
    assert bag(first, "row_hash_raw", "row_idx") == bag(rows.filter("row_idx IN (1, 3, 4)"), "row_hash_raw", "row_idx")
    assert "xxhash64" not in first._jdf.queryExecution().optimizedPlan().toString()
