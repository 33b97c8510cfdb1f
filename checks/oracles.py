"""DuckDB SQL each query must agree with.

Written rule by rule and table by table, not by translating the Spark expressions:
dates go through `try_strptime` per form, corruption through separate tests, the merge
through a join with CASE per column.
"""

from __future__ import annotations

from checks.views import (
    PRODUCTION_CELLS,
    PRODUCTION_RUNS,
    RUN_DAYS,
    VIDEO_CELLS,
    VIDEO_RUNS,
    production_sql,
    video_sql,
)
from contentlake.functions.text import WHITESPACE, snake_case
from contentlake.specs import PRODUCTION, VIDEO

# Columns, renames and hash order of silver and gold, stated apart from those of the library.
SILVER_VIDEO_TEXT = ("toko", "nama_kreator", "id_kreator", "informasi_video", "id_video", "produk")
SILVER_VIDEO_COUNTS = {
    **{c: c for c in ("vv", "likes", "komentar", "dibagikan", "pengikut_baru", "klik_video_ke_live")},
    **{c: c for c in ("produk_dilihat", "klik_produk", "pembeli", "pesanan_video")},
    "produk_yang_terjual_dari_video": "produk_terjual_video",
}
SILVER_VIDEO_MONEY = {
    "nilai_barang_dagangan_bruto_video_rp": "gmv_bruto_video",
    "gpm_rp": "gpm",
    "gmv_yang_didapat_dari_video_jualan_rp": "gmv_didapat_video",
}
SILVER_VIDEO_RATIOS = {
    "rasio_klik_tayang_video": "ctr_video",
    "rasio_video_ke_live": "ratio_video_ke_live",
    "persentase_video_yang_ditonton_hingga_selesai": "pct_tonton_selesai",
    "rasio_pesanan_per_klik_video": "cvr_video",
}
SILVER_VIDEO_COLUMNS = (
    "tanggal",
    *SILVER_VIDEO_TEXT,
    "waktu",
    *SILVER_VIDEO_COUNTS.values(),
    *SILVER_VIDEO_MONEY.values(),
    *SILVER_VIDEO_RATIOS.values(),
)
PRODUCTION_HASH_COLUMNS = tuple(
    """tanggal akun id_konten scripter editor produk jenis_konten tipe_konten talent_visual kategori_konten
    isu layout script brief_editing cta talent_vo referensi_musik sound visual_hook audio_hook progress_edit
    hook tingkat_konten tanggal_jadi progres_upload link_konten""".split()
)
SILVER_PRODUCTION_COLUMNS = PRODUCTION_HASH_COLUMNS  # the hash covers all of them
GOLD_SELECT = """a.id_video, a.tanggal, a.toko, a.nama_kreator, a.informasi_video, a.waktu,
  a.produk AS produk_sku, a.vv AS views, a.klik_video_ke_live, a.produk_dilihat, a.klik_produk, a.pembeli,
  a.pesanan_video, a.produk_terjual_video, a.gmv_bruto_video, a.gmv_didapat_video,
  b.tanggal AS tanggal_produksi, b.scripter, b.produk, b.editor, b.jenis_konten, b.tipe_konten, b.talent_visual,
  b.kategori_konten, b.isu, b.layout, b.script, b.cta, b.talent_vo, b.referensi_musik, b.sound, b.visual_hook,
  b.audio_hook, b.link_konten, b.hook"""

NUMERIC = {snake_case(c): c for c in VIDEO.numeric_columns}
PERCENT = {snake_case(c): c for c in VIDEO.percent_columns}
RAW_DATES = {"tanggal": "Tanggal", "waktu": "Waktu"}


# --- Scalar expressions ---------------------------------------------------------------


def strip(c: str) -> str:
    return f"trim({c}, '{WHITESPACE}')"


def upper_trim(c: str) -> str:
    return f"upper({strip(c)})"


def non_empty(c: str) -> str:
    return f"({c} IS NOT NULL AND lower({strip(c)}) NOT IN ('', 'nan', 'none', '-', 'n/a'))"


def blank(c: str) -> str:
    return f"({c} IS NULL OR lower({strip(c)}) IN ('', '-', 'nan', 'none', 'nat'))"


def date(c: str) -> str:
    t = strip(f"replace({c}, '\xa0', ' ')")
    n = f"replace(replace({t}, '-', '/'), '.', '/')"

    def rule(pattern: str, text: str, fmt: str) -> str:
        return f"WHEN regexp_full_match({text}, '{pattern}') THEN try_strptime({text}, '{fmt}')"

    parsed = f"""CASE
      {rule(r'[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}', n, '%Y/%m/%d')}
      {rule(r'[0-9]{4}/[0-9]{1,2}/[0-9]{1,2} +[0-9]{1,2}:[0-9]{2}:[0-9]{2}', t, '%Y/%m/%d %H:%M:%S')}
      {rule(r'[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}', n, '%d/%m/%Y')}
      {rule(r'[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}', n, '%d/%m/%y')}
      {rule(r'[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} +[0-9]{2}:[0-9]{2}:[0-9]{2}', t, '%Y-%m-%d %H:%M:%S')}
      WHEN regexp_full_match({t}, '[0-9]{{3,6}}')
        THEN CAST(DATE '1899-12-30' + CAST({t} AS INTEGER) AS TIMESTAMP) END"""
    return (
        f"(SELECT CASE WHEN year(p) BETWEEN 1900 AND 2100 THEN p END FROM (SELECT {parsed} AS p))"
    )


def number_text(c: str) -> str:
    return (
        f"replace(replace(regexp_replace({c}, '[^0-9,.]', '', 'g'), '.', ''), ',', '.')"
    )


def number(c: str) -> str:
    t = number_text(c)
    return (
        f"CASE WHEN regexp_full_match({t}, '[0-9]+[.]?[0-9]*|[.][0-9]+') "
        f"THEN TRY_CAST({t} AS DECIMAL(38,9)) END"
    )


def clean_number(c: str) -> str:
    return f"coalesce({number(c)}, 0)::DECIMAL(38,9)"


def numeric_corrupt(c: str) -> str:
    bad = r"[^0-9.,Rp\s\x{a0}#-]"
    return (
        f"({non_empty(c)} AND (regexp_matches({strip(c)}, '{bad}') OR {number(strip(c))} IS NULL "
        f"OR TRY_CAST(concat('0', split_part({number_text(strip(c))}, '.', 1)) AS BIGINT) IS NULL))"
    )


def percent_corrupt(c: str) -> str:
    bad = r"[^0-9.,%\s\x{a0}#-]"
    return f"({non_empty(c)} AND regexp_matches({strip(c)}, '{bad}'))"


def fraction(c: str) -> str:
    t = rf"regexp_replace({c}, '[%\\s]', '', 'g')"
    return (
        f"CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
        f"THEN CAST({t} AS DOUBLE) / 100.0 END"
    )


def plain(c: str) -> str:
    return f"regexp_replace(CAST(CAST({c} AS DECIMAL(38,9)) AS VARCHAR), '[.]?0+$', '')"


def seconds(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def sha(*parts: str) -> str:
    return f"sha256(concat_ws('||', {', '.join(parts)}))"


# --- Tables, as a chain of WITH parts ----------------------------------------------------


def with_parts(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


RAW_VIDEO = f"rv AS ({video_sql()})"
RAW_PRODUCTION = f"rp AS ({production_sql()})"
RUNS_VIDEO = "rv AS (" + " UNION ALL ".join(video_sql(n, w) for n, w in VIDEO_RUNS.items()) + ")"
RUNS_PRODUCTION = (
    "rp AS (" + " UNION ALL ".join(production_sql(n, w) for n, w in PRODUCTION_RUNS.items()) + ")"
)


def _any(tests: list[str]) -> str:
    return "(" + " OR ".join(tests) + ")" if tests else "FALSE"


def _annotated(name: str, raw: str, spec, cells) -> str:
    d0, d1 = spec.date_columns
    tests = [numeric_corrupt(c) for c in cells if c in NUMERIC and spec is VIDEO]
    tests += [percent_corrupt(c) for c in cells if c in PERCENT and spec is VIDEO]
    return f"""{name}0 AS (SELECT *, {date(d0)} AS d0, {date(d1)} AS d1,
  {_any(tests)} AS corrupt, {' AND '.join(blank(c) for c in cells)} AS is_blank
  FROM {raw} WHERE {spec.id_column} IS NULL OR {strip(spec.id_column)} <> ''),
{name} AS (SELECT *, d0 IS NULL AS bad0, d1 IS NULL AND {non_empty(d1)} AS bad1,
  (corrupt OR d0 IS NULL OR (d1 IS NULL AND {non_empty(d1)})) AND NOT is_blank AS is_error
  FROM {name}0)"""


ANN_VIDEO = _annotated("av", "rv", VIDEO, VIDEO_CELLS)
ANN_PRODUCTION = _annotated("ap", "rp", PRODUCTION, PRODUCTION_CELLS)


def reason(spec) -> str:
    d0, d1 = spec.date_columns
    n0, n1 = (RAW_DATES.get(d, d) if spec is VIDEO else d for d in (d0, d1))
    return f"""concat_ws('|', CASE WHEN corrupt THEN 'numeric_mixed' END,
    CASE WHEN bad0 THEN 'date_unparsable({n0}=' || coalesce({d0}, 'nan') || ')' END,
    CASE WHEN bad1 THEN 'date_unparsable({n1}=' || coalesce({d1}, 'nan') || ')' END)"""


_RUN_DAY = "CASE run_no " + " ".join(f"WHEN {n} THEN DATE '{d}'" for n, d in RUN_DAYS.items()) + " END"


def _valid_video() -> str:
    cols = []
    for c in VIDEO_CELLS:
        if c == "tanggal":
            cols.append("d0 AS tanggal")
        elif c == "waktu":
            cols.append("d1 AS waktu")
        elif c in NUMERIC:
            cols.append(f"{clean_number(c)} AS {c}")
        elif c in VIDEO.drop_columns:
            continue
        else:
            cols.append(f"nullif({c}, '') AS {c}")
    return f"""vv0 AS (SELECT row_idx, run_no, {', '.join(cols)}, creds, sheet_name
  FROM av WHERE NOT is_error AND NOT is_blank)"""


def hash_raw_video() -> str:
    def up(c: str) -> str:
        return f"coalesce({upper_trim(c)}, '')"

    return sha(
        seconds("tanggal"),
        up("toko"),
        up("nama_kreator"),
        up("id_video"),
        plain("vv"),
        plain("gmv_yang_didapat_dari_video_jualan_rp"),
    )


def _bronze_video(name: str) -> str:
    counts = ", ".join(f"CAST(round_even({c}, 0) AS BIGINT) AS {c}" for c in VIDEO.count_columns)
    return f"""{name} AS (SELECT * REPLACE ({counts}), {_RUN_DAY} AS snapshot_date,
  'run' || run_no AS run_id, {hash_raw_video()} AS row_hash_raw FROM vv0)"""


def hash_raw_production() -> str:
    return sha(
        seconds("tanggal"), f"coalesce({upper_trim('scripter')}, '')", f"coalesce({upper_trim('id_konten')}, '')"
    )


def _bronze_production(name: str) -> str:
    cols = []
    for c in PRODUCTION_CELLS:
        if c in PRODUCTION.drop_columns:
            continue
        cols.append({"tanggal": "d0 AS tanggal", "tanggal_jadi": "d1 AS tanggal_jadi"}.get(c, c))
    return f"""vp0 AS (SELECT row_idx, run_no, {', '.join(cols)}, creds, sheet_name
  FROM ap WHERE NOT is_error AND NOT is_blank),
{name} AS (SELECT *, {_RUN_DAY} AS snapshot_date, 'run' || run_no AS run_id,
  {hash_raw_production()} AS row_hash_raw FROM vp0)"""


def _first_per_run(name: str, src: str) -> str:
    return f"""{name} AS (SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY run_no, row_hash_raw ORDER BY row_idx) = 1)"""


BRONZE_VIDEO = (
    RUNS_VIDEO,
    ANN_VIDEO,
    _valid_video(),
    _bronze_video("bv0"),
    _first_per_run("bv", "bv0"),
)
BRONZE_PRODUCTION = (
    RUNS_PRODUCTION,
    ANN_PRODUCTION,
    _bronze_production("bp0"),
    _first_per_run("bp", "bp0"),
)


def _key(c: str) -> str:
    return upper_trim(f"coalesce({c}, '')")


VIDEO_KEY = (
    f"{upper_trim('toko')}, {_key('id_kreator')}, {_key('id_video')}, CAST(tanggal AS DATE)"
)
PRODUCTION_KEY = f"{upper_trim('akun')}, {_key('id_konten')}, CAST(tanggal AS DATE)"


def latest(name: str, bronze: str, key: str, runs: str = "1, 2, 3") -> str:
    return f"""{name} AS (SELECT * FROM {bronze} WHERE run_no IN ({runs})
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY run_no DESC, row_hash_raw DESC) = 1)"""


def silver_video_select() -> str:
    out = ["CAST(tanggal AS DATE) AS tanggal", *[f"{upper_trim(c)} AS {c}" for c in SILVER_VIDEO_TEXT], "waktu"]
    out += [f"{raw} AS {new}" for raw, new in {**SILVER_VIDEO_COUNTS, **SILVER_VIDEO_MONEY}.items()]
    out += [f"{fraction(raw)} AS {new}" for raw, new in SILVER_VIDEO_RATIOS.items()]
    return ", ".join(out)


def _or_empty(c: str) -> str:
    return f"coalesce({c}, '')"


def hash_clean_video() -> str:
    return sha(
        day("tanggal"),
        "toko",
        *[_or_empty(c) for c in ("id_kreator", "id_video", "nama_kreator", "informasi_video", "produk")],
        seconds("waktu"),
        *[f"CAST({c} AS VARCHAR)" for c in SILVER_VIDEO_COUNTS.values()],
        *[plain(c) for c in (*SILVER_VIDEO_MONEY.values(), *SILVER_VIDEO_RATIOS.values())],
    )


def silver_video(name: str, src: str) -> str:
    return f"""{name}b AS (SELECT {silver_video_select()}, snapshot_date, run_id, row_hash_raw FROM {src}),
{name} AS (SELECT *, {hash_clean_video()} AS row_hash_clean FROM {name}b)"""


def silver_production_select() -> str:
    out = []
    for c in SILVER_PRODUCTION_COLUMNS:
        if c in ("tanggal", "tanggal_jadi"):
            out.append(c)
        elif c == "link_konten":
            out.append(f"{strip(c)} AS {c}")
        else:
            out.append(f"{upper_trim(c)} AS {c}")
    return ", ".join(out)


def hash_clean_production() -> str:
    own = {"tanggal": seconds("tanggal"), "tanggal_jadi": seconds("tanggal_jadi"), "akun": "akun"}
    return sha(*[own.get(c, _or_empty(c)) for c in PRODUCTION_HASH_COLUMNS])


def silver_production(name: str, src: str) -> str:
    return f"""{name}b AS (SELECT {silver_production_select()}, snapshot_date, run_id, row_hash_raw FROM {src}),
{name} AS (SELECT *, {hash_clean_production()} AS row_hash_clean FROM {name}b)"""


LATEST_VIDEO = (*BRONZE_VIDEO, latest("lv", "bv", VIDEO_KEY))
LATEST_PRODUCTION = (*BRONZE_PRODUCTION, latest("lp", "bp", PRODUCTION_KEY))
SILVER_VIDEO = (*LATEST_VIDEO, silver_video("sv", "lv"))
SILVER_PRODUCTION = (*LATEST_PRODUCTION, silver_production("sp", "lp"))

TARGET_VIDEO = (
    latest("lv1", "bv", VIDEO_KEY, "1"),
    silver_video("tv0", "lv1"),
    "tv AS (SELECT * REPLACE (CASE WHEN likes % 29 <> 0 THEN row_hash_clean END AS row_hash_clean) FROM tv0)",
)
TARGET_PRODUCTION = (
    latest("lp1", "bp", PRODUCTION_KEY, "1"),
    silver_production("tp0", "lp1"),
    "tp AS (SELECT * REPLACE (CASE WHEN link_konten NOT LIKE '%7' THEN row_hash_clean END AS row_hash_clean) FROM tp0)",
)
LINEAGE = ("snapshot_date", "run_id", "row_hash_raw", "row_hash_clean")


def merge(name: str, target: str, source: str, on: str, keys: tuple, columns: tuple) -> str:
    action = """CASE WHEN t.in_t IS NULL THEN 'insert' WHEN s.in_s IS NULL THEN 'keep'
    WHEN t.row_hash_clean <> s.row_hash_clean THEN 'update' ELSE 'unchanged' END"""
    out = []
    for c in columns:
        new = "('insert')" if c in keys else "('insert', 'update')"
        out.append(f"CASE WHEN {action} IN {new} THEN s.{c} ELSE t.{c} END AS {c}")
    return f"""{name} AS (SELECT {', '.join(out)}, {action} AS action
  FROM (SELECT *, 1 AS in_t FROM {target}) t FULL OUTER JOIN (SELECT *, 1 AS in_s FROM {source}) s ON {on})"""


VIDEO_ON = (
    "t.tanggal = s.tanggal AND t.toko = s.toko AND coalesce(t.id_kreator, '') = coalesce(s.id_kreator, '') "
    "AND coalesce(t.id_video, '') = coalesce(s.id_video, '')",
    ("tanggal", "toko", "id_kreator", "id_video"),
    (*SILVER_VIDEO_COLUMNS, *LINEAGE),
)
PRODUCTION_ON = (
    f"t.tanggal = s.tanggal AND {upper_trim('t.akun')} = s.akun "
    f"AND coalesce({upper_trim('t.id_konten')}, '') = coalesce(s.id_konten, '')",
    ("tanggal", "akun", "id_konten"),
    (*SILVER_PRODUCTION_COLUMNS, *LINEAGE),
)
MERGE_VIDEO = (*SILVER_VIDEO, *TARGET_VIDEO, merge("mv", "tv", "sv", *VIDEO_ON))
MERGE_PRODUCTION = (*SILVER_PRODUCTION, *TARGET_PRODUCTION, merge("mp", "tp", "sp", *PRODUCTION_ON))

DEDUP = """dim AS (SELECT * FROM sp
  QUALIFY row_number() OVER (PARTITION BY id_konten ORDER BY tanggal DESC, akun DESC NULLS LAST, row_hash_clean DESC) = 1)"""


# --- The daily job: three runs, each past the marks the runs before it left ------------------


def _past_marks(bronze: str, out: str) -> tuple[str, ...]:
    """Rows each run loads. A mark is the newest day a source has loaded so far."""
    parts = [f"{out}1 AS (SELECT * FROM {bronze} WHERE run_no = 1)"]
    for n in (2, 3):
        loaded = " UNION ALL ".join(f"SELECT creds, tanggal FROM {out}{i}" for i in range(1, n))
        parts.append(f"""{out}{n} AS (SELECT b.* FROM {bronze} b LEFT JOIN
  (SELECT creds, date_trunc('day', max(tanggal)) AS mark FROM ({loaded}) u GROUP BY creds) k ON k.creds = b.creds
  WHERE b.run_no = {n} AND (k.mark IS NULL OR b.tanggal > k.mark))""")
    rows = " UNION ALL ".join(f"SELECT * FROM {out}{n}" for n in (1, 2, 3))
    parts.append(f"""{out} AS (SELECT * FROM ({rows}) u
  QUALIFY row_number() OVER (PARTITION BY run_no, row_hash_raw ORDER BY sheet_name, row_idx) = 1)""")
    return tuple(parts)


def _merged_thrice(name: str, bronze: str, key: str, silver, on: tuple) -> tuple[str, ...]:
    """Silver after three merges; the source of each is the latest row of all runs so far."""
    parts: list[str] = []
    for n, runs in ((1, "1"), (2, "1, 2"), (3, "1, 2, 3")):
        parts += [latest(f"{name}l{n}", bronze, key, runs), silver(f"{name}s{n}", f"{name}l{n}")]
    parts += [merge(f"{name}m2", f"{name}s1", f"{name}s2", *on), merge(f"{name}m3", f"{name}m2", f"{name}s3", *on)]
    return tuple(parts)


# A source is named by the registry of its sheet.
JOB_RUNS_VIDEO = (
    "rv AS (SELECT * REPLACE ('cred' || least(CAST(substr(sheet_name, 6) AS INTEGER), 3) AS creds) FROM ("
    + " UNION ALL ".join(video_sql(n, w) for n, w in VIDEO_RUNS.items())
    + ") u)"
)
JOB_ANN_VIDEO = (JOB_RUNS_VIDEO, ANN_VIDEO)
JOB_BRONZE_VIDEO = (*JOB_ANN_VIDEO, _valid_video(), _bronze_video("bv0"), *_past_marks("bv0", "bv"))
JOB_BRONZE_PRODUCTION = (
    RUNS_PRODUCTION,
    ANN_PRODUCTION,
    _bronze_production("bp0"),
    *_past_marks("bp0", "bp"),
)
JOB_SILVER_VIDEO = (*JOB_BRONZE_VIDEO, *_merged_thrice("v", "bv", VIDEO_KEY, silver_video, VIDEO_ON))
JOB_SILVER_PRODUCTION = (
    *JOB_BRONZE_PRODUCTION,
    *_merged_thrice("p", "bp", PRODUCTION_KEY, silver_production, PRODUCTION_ON),
)
