"""Dirty spreadsheet views over the driver tables.

One SQL text serves Spark and DuckDB. Every view covers the whole table: each row of
`events` / `orders` becomes a sheet row whose cells are written in the mixed formats
the operators must cope with. Arithmetic on keys only picks a format, never a row.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.functions.text import q, snake_case
from contentlake.operators.latest import first_by_hash
from contentlake.operators.validate import annotate, rows_with_id, valid_rows
from contentlake.plans.bronze import build_bronze
from contentlake.plans.daily import Sheets, run_daily
from contentlake.plans.silver import silver_production, silver_video
from contentlake.sources.files import scratch_dir
from contentlake.specs import PRODUCTION, VIDEO, DatasetSpec

VIDEO_DROPPED = ("gmv_video_rp", "diagnosis")
VIDEO_CELLS = (
    *VIDEO.date_columns,
    *VIDEO.text_columns,
    *[snake_case(c) for c in VIDEO.numeric_columns],
    *[snake_case(c) for c in VIDEO.percent_columns],
    *VIDEO_DROPPED,
)
PRODUCTION_CELLS = (*PRODUCTION.date_columns, *PRODUCTION.text_columns, "kode", "bulan")

_PARTS = """CAST(year({ts}) AS STRING) AS y, CAST(month({ts}) AS STRING) AS m,
  CAST(day({ts}) AS STRING) AS d, lpad(CAST(month({ts}) AS STRING), 2, '0') AS mm,
  lpad(CAST(day({ts}) AS STRING), 2, '0') AS dd,
  lpad(CAST(hour({ts}) AS STRING), 2, '0') || ':' || lpad(CAST(minute({ts}) AS STRING), 2, '0') || ':00' AS hms"""


def _whole(expr: str) -> str:
    """Number cell with a thousands dot."""
    return (
        f"CAST({expr} % 9 + 1 AS STRING) || '.' || lpad(CAST({expr} % 1000 AS STRING), 3, '0')"
    )


def _rupiah(a: str, b: str) -> str:
    return (
        f"'Rp ' || CAST({a} % 7 + 1 AS STRING) || '.' || lpad(CAST({b} % 1000 AS STRING), 3, '0')"
        f" || ',' || lpad(CAST({a} % 100 AS STRING), 2, '0')"
    )


def _percent(expr: str) -> str:
    return f"CAST({expr} % 100 AS STRING) || '.5%'"


_VIDEO_TANGGAL = """CASE event_id % 8
    WHEN 0 THEN y || '-' || mm || '-' || dd
    WHEN 1 THEN dd || '/' || mm || '/' || y
    WHEN 2 THEN y || '/' || mm || '/' || dd
    WHEN 3 THEN d || '.' || m || '.' || y
    WHEN 4 THEN dd || '/' || mm || '/' || substr(y, 3, 2)
    WHEN 5 THEN CAST(45291 + day(ts) AS STRING)
    WHEN 6 THEN y || '-' || mm || '-' || dd || ' ' || hms
    ELSE CASE event_id % 56
      WHEN 7 THEN '' WHEN 15 THEN '31/02/2024' WHEN 23 THEN 'abc'
      WHEN 31 THEN '202401' WHEN 39 THEN '-'
      ELSE '  ' || dd || '-' || mm || '-' || y || ' ' END
  END"""

_VIDEO_EXPR = {
    "tanggal": _VIDEO_TANGGAL,
    "waktu": """CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 31 = 0 THEN 'soon'
    ELSE y || '/' || mm || '/' || dd || ' ' || hms END""",
    "toko": """CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 3 = 0 THEN '  ' || event_type
    WHEN event_id % 3 = 1 THEN upper(event_type) ELSE event_type || '\xa0' END""",
    "nama_kreator": "'kreator ' || CAST(user_id % 20 AS STRING)",
    "id_kreator": "CASE WHEN event_id % 41 = 0 THEN '' ELSE CAST(user_id AS STRING) END",
    "informasi_video": "' ' || props || ' '",
    "id_video": """CASE WHEN event_id % 211 = 0 THEN '' ELSE 'v' || CAST(event_id % 1500 AS STRING) END""",
    "produk": "'Produk ' || CAST(user_id % 7 AS STRING)",
    "vv": f"""CASE event_id % 50 WHEN 1 THEN '12%' WHEN 2 THEN '######' WHEN 3 THEN '-'
    WHEN 4 THEN 'n/a' WHEN 5 THEN '1,2,3' WHEN 6 THEN '-5' WHEN 7 THEN '99999999999999999999'
    WHEN 8 THEN '9999999999999999999999999999999' WHEN 9 THEN '9999999999999999999999999999999999999999'
    ELSE {_whole('(event_id + {n})')} END""",
    "likes": _whole("(event_id * 3)"),
    "komentar": "CASE WHEN user_id % 9 = 0 THEN '' ELSE CAST(event_id % 77 AS STRING) || ',5' END",
    "dibagikan": "CAST(user_id % 12 AS STRING)",
    "pengikut_baru": "CASE WHEN event_id % 113 = 0 THEN 'IDR' ELSE CAST(user_id % 5 AS STRING) END",
    "klik_video_ke_live": "CAST(event_id % 6 AS STRING)",
    "produk_dilihat": _whole("(event_id * 7)"),
    "klik_produk": "CAST(event_id % 40 AS STRING)",
    "pembeli": "CAST(event_id % 11 AS STRING)",
    "pesanan_video": "CAST(event_id % 13 AS STRING)",
    "produk_yang_terjual_dari_video": "CAST(event_id % 17 AS STRING)",
    "nilai_barang_dagangan_bruto_video_rp": _rupiah("event_id", "user_id"),
    "gpm_rp": _rupiah("user_id", "event_id"),
    "gmv_yang_didapat_dari_video_jualan_rp": _rupiah("(event_id + 3)", "user_id"),
    "rasio_klik_tayang_video": f"""CASE event_id % 37 WHEN 0 THEN 'IDR' WHEN 1 THEN '0,00%'
    WHEN 2 THEN '######' ELSE {_percent('event_id')} END""",
    "rasio_video_ke_live": _percent("user_id"),
    "persentase_video_yang_ditonton_hingga_selesai": "CAST(user_id % 100 AS STRING)",
    "rasio_pesanan_per_klik_video": "CASE WHEN user_id % 10 = 0 THEN '-' ELSE "
    + _percent("(event_id + user_id)")
    + " END",
    "gmv_video_rp": _rupiah("event_id", "event_id"),
    "diagnosis": "event_type",
}

_PRODUCTION_EXPR = {
    "tanggal": """CASE o_orderkey % 5
    WHEN 0 THEN y || '-' || mm || '-' || dd
    WHEN 1 THEN dd || '/' || mm || '/' || y
    WHEN 2 THEN d || '-' || m || '-' || y
    WHEN 3 THEN y || '/' || m || '/' || d || ' 7:08:09'
    ELSE CASE WHEN o_orderkey % 85 = 4 THEN 'TBD' WHEN o_orderkey % 85 = 9 THEN ''
      ELSE y || '.' || mm || '.' || dd END END""",
    "tanggal_jadi": """CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 47 = 0 THEN 'besok'
    ELSE y || '-' || mm || '-' || dd || ' 10:00:00' END""",
    "akun": "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE ' ' || lower(o_orderpriority) || '\xa0' END",
    "id_konten": "CASE WHEN o_orderkey % 53 = 0 THEN '' ELSE 'v' || CAST(o_orderkey % 1500 AS STRING) END",
    "scripter": "'scripter ' || CAST(o_custkey % 10 AS STRING)",
    "editor": "'editor ' || CAST((o_custkey + {n}) % 4 AS STRING)",
    "link_konten": "' https://Video/' || CAST(o_orderkey AS STRING) || ' '",
    "kode": "CAST(o_orderkey AS STRING)",
    "bulan": "m",
}


def _cell(name: str, exprs: dict[str, str], key: str) -> str:
    return exprs.get(name, f"'{name} ' || CAST({key} % 3 AS STRING) || ' '")


def video_sql(run: int = 0, where: str = "TRUE") -> str:
    """Raw video rows from `events`; half of the '-' dates are rows blank throughout."""
    cells = ",\n".join(
        f"  CASE WHEN event_id % 112 = 39 THEN '-' ELSE {_cell(c, _VIDEO_EXPR, 'user_id')} END AS {c}"
        for c in VIDEO_CELLS
    ).replace("{n}", str(run))
    return f"""SELECT event_id AS row_idx,
{cells},
  'cred' || CAST(user_id % 4 AS STRING) AS creds,
  'sheet' || CAST(user_id % 5 AS STRING) AS sheet_name,
  {run} AS run_no
FROM (SELECT *, {_PARTS.format(ts='ts')} FROM events WHERE {where}) e"""


def production_sql(run: int = 0, where: str = "TRUE") -> str:
    """Raw production rows from `orders`: one sheet, so one source holds every row."""
    cells = ",\n".join(
        f"  {_cell(c, _PRODUCTION_EXPR, 'o_custkey')} AS {c}" for c in PRODUCTION_CELLS
    ).replace("{n}", str(run))
    return f"""SELECT o_orderkey AS row_idx,
{cells},
  'cred_p' AS creds,
  'produksi' AS sheet_name,
  {run} AS run_no
FROM (SELECT *, {_PARTS.format(ts='o_orderdate')} FROM orders WHERE {where}) o"""


# Three runs see overlapping spans of time, so most rows are snapshotted more than
# once, and together the runs cover the whole table.
VIDEO_RUNS = {
    1: "day(ts) <= 12",
    2: "day(ts) > 6 AND day(ts) <= 22",
    3: "day(ts) > 16",
}
PRODUCTION_RUNS = {
    1: "year(o_orderdate) <= 1997",
    2: "year(o_orderdate) > 1995 AND year(o_orderdate) <= 1999",
    3: "year(o_orderdate) > 1997",
}
RUN_DAYS = {0: "2024-02-01", 1: "2024-02-01", 2: "2024-02-02", 3: "2024-02-03"}

_RAW_NAMES = {
    snake_case(c): c for c in (*VIDEO.numeric_columns, *VIDEO.percent_columns)
} | {"tanggal": "Tanggal", "waktu": "Waktu"}


def register(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


#: Rows a task makes sheet rows of and sorts: some 200 MB of wide rows, whatever the table's size.
ROWS_A_TASK = 250_000


def register_dealt(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> None:
    """`table` under its name, its few columns dealt out before the wide cells are made of them: however
    the files are cut, each core has its share, a task has a bounded number of rows, and no wide row is shuffled
    for it. A share by bytes would not do, as these few columns grow more than tenfold; only rows too few to be worth
    a task for each core are left to Spark."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)
    n_rows = df.count()
    n_tasks = max(spark.sparkContext.defaultParallelism, -(-n_rows // ROWS_A_TASK))
    dealt = df.hint("rebalance") if n_rows <= ROWS_A_TASK // 100 else df.repartition(n_tasks)
    dealt.createOrReplaceTempView(table)


def raw_video(spark: SparkSession, sf_dir: str, run: int = 0) -> DataFrame:
    """Raw video sheet rows under their real header names."""
    register_dealt(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    df = spark.sql(video_sql(run, VIDEO_RUNS.get(run, "TRUE"))).drop("run_no")
    return df.selectExpr(*[f"{c} AS {q(_RAW_NAMES.get(c, c))}" for c in df.columns])


def raw_production(spark: SparkSession, sf_dir: str, run: int = 0) -> DataFrame:
    register_dealt(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return spark.sql(production_sql(run, PRODUCTION_RUNS.get(run, "TRUE"))).drop("run_no")


# --- Small tables: state, registry, landed cells -------------------------------------

SOURCES_SQL = """SELECT 'sheet' || CAST(user_id % 5 AS STRING) AS sheet_name,
  'cred' || CAST(CASE user_id % 5 WHEN 4 THEN 3 ELSE user_id % 5 END AS STRING) AS creds,
  CAST(user_id % 5 AS INT) AS sheet_ord
FROM events GROUP BY user_id % 5"""

MARKS_SQL = """SELECT 'cred' || CAST(user_id % 4 AS STRING) AS creds,
  '2024-01-' || CAST(10 + user_id % 4 AS STRING) AS mark
FROM events WHERE 'cred' || CAST(user_id % 4 AS STRING) <> 'cred3' GROUP BY user_id % 4"""

# One source per user; three sheets share a source id; users who came late are not registered.
REGISTRY_SQL = """SELECT 'user' || CAST(user_id AS STRING) AS sheet_name,
  'id' || CAST(user_id - user_id % 3 AS STRING) AS creds, CAST(user_id AS INT) AS sheet_ord
FROM events GROUP BY user_id HAVING min(day(ts)) <= 1"""

# Old-format rows have no creds, some rows hold a stale one.
STATE_SQL = """SELECT CASE WHEN u % 2 = 1 THEN NULL WHEN u % 10 = 0 THEN 'SH_KEY_' || CAST(u AS STRING)
    ELSE 'id' || CAST(u AS STRING) END AS creds,
  'user' || CAST(u AS STRING) AS sheet_name,
  CAST(last_day AS STRING) || ' 10:00' AS last_processed_date,
  CASE WHEN u % 7 = 0 THEN NULL ELSE '2024-01-2' || CAST(u % 5 AS STRING) || 'T06:00:00' END AS updated_at,
  u AS ord
FROM (SELECT user_id AS u, max(CAST(ts AS DATE)) AS last_day FROM events WHERE day(ts) <= 20 GROUP BY user_id) s"""

FRESH_SQL = """SELECT 'id' || CAST(user_id AS STRING) AS creds, CAST(max(CAST(ts AS DATE)) AS STRING) AS max_date
FROM events WHERE event_type = 'purchase' AND day(ts) > 20 GROUP BY user_id"""

# Landed sheets: two title rows, a header row, then data. Two column orders; the first
# repeats a header name, the second lacks one column and has another instead.
LANDED_SQL = """SELECT sheet_name, row_idx, CASE WHEN k < 3 THEN array(a, b, c, 'second ' || b)
    ELSE array(c, a, e) END AS cells
FROM (SELECT 'sheet' || CAST(user_id % 5 AS STRING) AS sheet_name, user_id % 5 AS k,
    event_id + 3 AS row_idx, CAST(CAST(ts AS DATE) AS STRING) AS a, event_type AS b,
    CAST(user_id AS STRING) AS c, props AS e FROM events) d
UNION ALL
SELECT 'sheet' || CAST(user_id % 5 AS STRING), CAST(2 AS BIGINT),
  CASE WHEN user_id % 5 < 3 THEN array('Tanggal', 'Toko', 'VV', 'Toko') ELSE array('VV', 'Tanggal', 'No. Video') END
FROM events GROUP BY user_id % 5
UNION ALL
SELECT 'sheet' || CAST(user_id % 5 AS STRING), CAST(0 AS BIGINT), array('title', '')
FROM events GROUP BY user_id % 5"""

BLANK_SQL = """SELECT event_id AS row_idx,
  CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '-' WHEN 2 THEN 'nan' ELSE 'n/a' END AS a,
  CASE event_id % 5 WHEN 0 THEN ' ' WHEN 1 THEN ' - ' WHEN 2 THEN 'None' WHEN 3 THEN 'NaT' ELSE event_type END AS b,
  CASE event_id % 6 WHEN 0 THEN NULL WHEN 5 THEN event_type ELSE '\xa0' END AS c,
  'cred' || CAST(user_id % 4 AS STRING) AS creds, event_type AS sheet_name
FROM events"""


def from_sql(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    register(spark, sf_dir, *(tables or ("events",)))
    return spark.sql(sql)


# --- Derived tables: written once per session to the cluster's shared folder ---------

_STAGED: dict[tuple[str, str, str], str] = {}


_OWN_ROOT: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a folder of its own only where unset."""
    if not _OWN_ROOT and spark.conf.get("spark.checkpoint.dir", None) is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _OWN_ROOT.append(tempfile.mkdtemp(prefix="contentlake-"))
    return scratch_dir(spark, _OWN_ROOT[0] if _OWN_ROOT else "")


def staged(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    build: Callable[[], DataFrame],
    hint: str | None = None,
) -> DataFrame:
    """The table `name` derived from `sf_dir`, built on first use; without `hint` in the order it has, as
    what builds it has dealt its rows out already.

    The operators then read plain parquet as they would in a lake, not the large
    expressions that make the cells dirty.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        path = f"{scratch_root(spark)}/{uuid.uuid4().hex}/{name}"
        df = build()
        # Small row groups: a file is read in as many pieces as its size asks for.
        (df.hint(hint) if hint else df).write.option("parquet.block.size", 4 << 20).parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def sheet_rows(spark: SparkSession, sf_dir: str, spec: DatasetSpec, run: int = 0) -> DataFrame:
    make = raw_video if spec is VIDEO else raw_production
    return staged(
        spark, sf_dir, f"raw_{spec.name}_{run}", lambda: make(spark, sf_dir, run)
    )


def made_once(df: DataFrame) -> DataFrame:
    """`df` with each row's cells made once, as one struct, however many expressions and filters read them: what is
    read by a single step need not be staged for it."""
    row = F.struct(*[F.col(q(c)) for c in df.columns])
    return df.select(F.inline(F.array(row)))


def run_ts(run: int) -> datetime:
    return datetime.fromisoformat(f"{RUN_DAYS[run]}T06:00:00+00:00")


def annotated(spark: SparkSession, sf_dir: str, spec: DatasetSpec, run: int = 0) -> DataFrame:
    make = raw_video if spec is VIDEO else raw_production
    raw = made_once(make(spark, sf_dir, run))
    return annotate(rows_with_id(raw, spec), spec)


def staged_annotated(spark: SparkSession, sf_dir: str, spec: DatasetSpec) -> DataFrame:
    return staged(
        spark, sf_dir, f"annotated_{spec.name}", lambda: annotated(spark, sf_dir, spec)
    )


def bronze_run(spark: SparkSession, sf_dir: str, spec: DatasetSpec, run: int) -> DataFrame:
    """What one run loads into an empty bronze table: first row per hash."""
    valid = valid_rows(annotated(spark, sf_dir, spec, run), spec)
    rows = build_bronze(valid, spec, run_ts(run), f"run{run}")
    return first_by_hash(rows, [F.asc("row_idx")])


def bronze(spark: SparkSession, sf_dir: str, spec: DatasetSpec, runs=(1, 2, 3)) -> DataFrame:
    """Bronze after the given runs, each appended as its own part."""
    parts = [
        staged(
            spark,
            sf_dir,
            f"bronze_{spec.name}_{r}",
            lambda r=r: bronze_run(spark, sf_dir, spec, r),
        )
        for r in runs
    ]
    return reduce(DataFrame.unionByName, parts)


def silver_target(spark: SparkSession, sf_dir: str, spec: DatasetSpec) -> DataFrame:
    """Silver after the first run. Some rows carry no hash, as rows written before the
    hash existed would."""

    def build() -> DataFrame:
        make, odd = (
            (silver_video, F.col("likes") % 29 == 0)
            if spec is VIDEO
            else (silver_production, F.col("link_konten").endswith("7"))
        )
        df = make(bronze(spark, sf_dir, spec, (1,)))
        return df.withColumn("row_hash_clean", F.when(~odd, F.col("row_hash_clean")))

    return staged(spark, sf_dir, f"silver_{spec.name}_1", build)


def silver_source(spark: SparkSession, sf_dir: str, spec: DatasetSpec) -> DataFrame:
    make = silver_video if spec is VIDEO else silver_production
    return make(bronze(spark, sf_dir, spec))


def silver_full(spark: SparkSession, sf_dir: str, spec: DatasetSpec) -> DataFrame:
    """Silver after all runs."""
    return staged(
        spark, sf_dir, f"silver_{spec.name}", lambda: silver_source(spark, sf_dir, spec)
    )


# --- The daily job over the three runs --------------------------------------------------

_LAKES: dict[tuple[str, str], str] = {}

JOB_REGISTRY_SQL = f"""{SOURCES_SQL}
UNION ALL SELECT 'produksi', 'cred_p', CAST(5 AS INT)"""


def landed_run(spark: SparkSession, sf_dir: str, spec: DatasetSpec, run: int) -> DataFrame:
    """The sheets of one run as they land: a header row, then cells by position."""
    make = raw_video if spec is VIDEO else raw_production
    raw = make(spark, sf_dir, run)
    names = [c for c in raw.columns if c not in ("row_idx", "creds", "sheet_name")]
    head = F.lit(spec.header_row)

    def build() -> DataFrame:
        data = raw.select(
            "sheet_name",
            (F.col("row_idx") + head + 1).alias("row_idx"),
            F.array(*[F.col(q(c)) for c in names]).alias("cells"),
        )
        heads = raw.select("sheet_name").distinct().select(
            "sheet_name",
            head.cast("bigint").alias("row_idx"),
            F.array(*[F.lit(c) for c in names]).alias("cells"),
        )
        return data.unionByName(heads)

    return staged(spark, sf_dir, f"landed_{spec.name}_{run}", build)


def job_lake(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a lake the daily job has filled in three runs."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        root = f"{scratch_root(spark)}/{uuid.uuid4().hex}/lake"
        registry = staged(spark, sf_dir, "job_registry", lambda: from_sql(spark, sf_dir, JOB_REGISTRY_SQL))
        specs = (VIDEO, PRODUCTION)
        register(spark, sf_dir, "events", "orders")
        with ThreadPoolExecutor(len(specs)) as pool:
            land = inheritable_thread_target(spark)(lambda of: landed_run(spark, sf_dir, *of))
            landed = dict(zip(product(specs, (1, 2, 3)), pool.map(land, product(specs, (1, 2, 3)))))
        for n in (1, 2, 3):
            sheets = {spec.name: Sheets(landed[spec, n], registry) for spec in specs}
            run_daily(spark, root, sheets, run_ts(n), f"run{n}")
        _LAKES[key] = root
    return _LAKES[key]
