"""DuckDB SQL per query name."""

from __future__ import annotations

from checks import oracles as o
from checks import views as v
from contentlake.functions.text import snake_case
from contentlake.specs import PRODUCTION, VIDEO

W = o.with_parts
REPORTED_AT, PATH = "2024-02-01T06:00:00", "quarantine/video"

RAW = W(o.RAW_VIDEO)
ANN = (o.RAW_VIDEO, o.ANN_VIDEO)
ANN_P = (o.RAW_PRODUCTION, o.ANN_PRODUCTION)
NUMERIC = [snake_case(c) for c in VIDEO.numeric_columns]
PERCENT = [snake_case(c) for c in VIDEO.percent_columns]
TAGS = "creds, sheet_name"
BRONZE_COLS = ", ".join(c for c in v.VIDEO_CELLS if c not in VIDEO.drop_columns)
BRONZE_COLS_P = ", ".join(c for c in v.PRODUCTION_CELLS if c not in PRODUCTION.drop_columns)
# Every run is at six o'clock of its day.
SNAPSHOT_TS = "CAST(snapshot_date AS TIMESTAMP) + INTERVAL 6 HOUR AS snapshot_ts"
LINEAGE = f"snapshot_date, {SNAPSHOT_TS}, run_id, row_hash_raw"


def _landed() -> str:
    return """SELECT CAST(CAST(ts AS DATE) AS STRING) AS tanggal,
  CASE WHEN user_id % 5 < 3 THEN event_type END AS toko, CAST(user_id AS STRING) AS vv,
  CASE WHEN user_id % 5 >= 3 THEN props END AS no_video,
  'cred' || CASE user_id % 5 WHEN 4 THEN 3 ELSE user_id % 5 END AS creds,
  'sheet' || (user_id % 5) AS sheet_name, CAST(user_id % 5 AS INT) AS sheet_ord,
  event_id + 3 AS row_idx FROM events"""


def _flagged(columns: dict[str, str], test) -> str:
    hits = ", ".join(f"CASE WHEN {test(c)} THEN '{raw}' END" for c, raw in columns.items())
    return f"SELECT row_idx, concat_ws('|', {hits}) AS columns FROM rv"


_OUTCOME = "CASE WHEN is_blank THEN 'blank' WHEN is_error THEN 'error' ELSE 'valid' END AS outcome"

# Columns with a flagged cell, in the order numeric, percent, dates.
_AFFECTED_NAMES = "concat_ws('|', " + ", ".join(
    [f"CASE WHEN bool_or({o.numeric_corrupt(c)}) THEN '{r}' END" for c, r in o.NUMERIC.items()]
    + [f"CASE WHEN bool_or({o.percent_corrupt(c)}) THEN '{r}' END" for c, r in o.PERCENT.items()]
    + ["CASE WHEN bool_or(bad0) THEN 'Tanggal' END", "CASE WHEN bool_or(bad1) THEN 'Waktu' END"]
) + ") AS names"
_AFFECTED = f"affected AS (SELECT {_AFFECTED_NAMES} FROM av)"
_AFFECTED_SQL = (*ANN, _AFFECTED)

_ERR_DATE = "coalesce(strftime(d0, '%Y-%m-%d'), 'INVALID_DATE')"
_ENTRIES = f"""entries AS (SELECT sheet_name, creds, {_ERR_DATE} AS error_date,
  (SELECT names FROM affected) AS affected_columns, count(*) AS n_rows,
  '{REPORTED_AT}' AS reported_at, '{PATH}' AS path, 'open' AS status
  FROM av WHERE is_error GROUP BY ALL)"""
_COUNTS = """counts AS (SELECT sheet_name, creds, strftime(d0, '%Y-%m-%d') AS error_date,
  count(*) AS n_valid FROM av WHERE NOT is_error AND NOT is_blank GROUP BY ALL)"""
_OPEN = """opened AS (SELECT *, 'VV' AS affected_columns, '2024-01-31T06:00:00' AS reported_at,
  'old' AS path, 'open' AS status FROM (
  SELECT sheet_name, creds, error_date, n_valid + CASE WHEN n_valid % 3 = 0 THEN 1 ELSE 0 END AS n_rows FROM counts
  UNION ALL SELECT sheet_name, creds, 'INVALID_DATE', count(*) FROM counts GROUP BY sheet_name, creds) u)"""
_CLASSIFIED = """classified AS (SELECT p.*, CASE
  WHEN EXISTS (SELECT 1 FROM entries e WHERE e.sheet_name = p.sheet_name AND e.creds = p.creds
    AND e.error_date = p.error_date) THEN 'refreshed'
  WHEN EXISTS (SELECT 1 FROM counts c WHERE c.sheet_name = p.sheet_name AND c.creds = p.creds
    AND c.error_date = p.error_date AND c.n_valid = p.n_rows) THEN 'resolved'
  ELSE 'kept' END AS outcome FROM opened p)"""
_ENTRIES_SQL = (*_AFFECTED_SQL, _ENTRIES)
_SYNC_SQL = (*_ENTRIES_SQL, _COUNTS, _OPEN, _CLASSIFIED)
_OPEN_SQL = (*ANN, _COUNTS, _OPEN)
_ENTRY_COLS = (
    "sheet_name, creds, error_date, affected_columns, n_rows, reported_at, path, status"
)
_CONFIRMED = """SELECT p.sheet_name, p.creds, p.error_date FROM opened p JOIN counts c
  ON c.sheet_name = p.sheet_name AND c.creds = p.creds AND c.error_date = p.error_date
  WHERE c.n_valid = p.n_rows AND p.n_rows > 0"""


def _values() -> str:
    parts = [
        f"SELECT sheet_name, creds, {_ERR_DATE} AS error_date, {o.strip(c)} AS bad_value "
        f"FROM av WHERE is_error AND (SELECT list_contains(string_split(names, '|'), '{raw}') FROM affected)"
        for c, raw in {**o.NUMERIC, **o.PERCENT, **o.RAW_DATES}.items()
    ]
    union = " UNION ".join(parts)
    return f"""vals AS (SELECT * FROM ({union}) u WHERE bad_value IS NOT NULL
  AND lower(bad_value) NOT IN ('', 'nan', 'none', '-', 'n/a', 'nat'))"""


_VALUES_SQL = (*_AFFECTED_SQL, _values())


def _parts(name: str, values: str, size: int, also: str = "") -> str:
    """Sorted values in parts of `size`, per key (and `also`)."""
    return f"""{name} AS (SELECT {also}sheet_name, creds, error_date, part, string_agg(bad_value, '|' ORDER BY bad_value) AS bad_values
  FROM (SELECT *, CAST((row_number() OVER (PARTITION BY {also}sheet_name, creds, error_date ORDER BY bad_value) - 1) // {size} AS BIGINT) AS part
    FROM {values}) r GROUP BY ALL)"""


_PARTS = _parts("parts", "vals", 100)
_FULL = f"""full_entries AS (SELECT {', '.join('e.' + c for c in _ENTRY_COLS.split(', '))},
  coalesce(p.part, 0) AS part, coalesce(p.bad_values, '') AS bad_values
  FROM entries e LEFT JOIN parts p ON p.sheet_name = e.sheet_name AND p.creds = e.creds AND p.error_date = e.error_date)"""
_FULL_SQL = (*_VALUES_SQL, _ENTRIES, _PARTS, _FULL)


def _recovered(inside: bool) -> str:
    keep = "IN" if inside else "NOT IN"
    return f"""SELECT row_idx, sheet_name, creds FROM av WHERE NOT is_error AND NOT is_blank
  AND (sheet_name, creds, strftime(d0, '%Y-%m-%d')) {keep} ({_CONFIRMED})"""


_MARKED = f"""marked AS (SELECT a.row_idx, a.creds, a.d0 AS tanggal FROM av a
  LEFT JOIN ({v.MARKS_SQL}) m ON m.creds = a.creds
  WHERE NOT is_error AND NOT is_blank AND (m.mark IS NULL OR a.d0 > CAST(m.mark AS TIMESTAMP)))"""

_STATE = (f"st AS ({v.STATE_SQL})", f"reg AS ({v.REGISTRY_SQL})", f"fresh AS ({v.FRESH_SQL})")
_MIGRATED = """by_creds AS (SELECT creds, arg_max(sheet_name, sheet_ord) AS name FROM reg GROUP BY creds),
resolved AS (SELECT CASE WHEN nullif(s.creds, '') IS NULL THEN coalesce(r.creds, s.sheet_name)
    WHEN NOT EXISTS (SELECT 1 FROM reg x WHERE x.creds = s.creds) AND r.creds IS NOT NULL THEN r.creds
    ELSE s.creds END AS creds, s.sheet_name, s.last_processed_date,
    coalesce(s.updated_at, '') AS updated_at, s.ord
  FROM st s LEFT JOIN reg r ON r.sheet_name = s.sheet_name),
old AS (SELECT a.creds, coalesce(b.name, a.sheet_name) AS sheet_name, a.last_processed_date, a.updated_at
  FROM resolved a LEFT JOIN by_creds b ON b.creds = a.creds
  QUALIFY row_number() OVER (PARTITION BY a.creds ORDER BY a.updated_at DESC, a.ord DESC) = 1)"""

_BATCH = (
    o.RAW_VIDEO,
    o.ANN_VIDEO,
    o._valid_video(),
    o._bronze_video("bv"),
    _COUNTS,
    _OPEN,
    f"""flagged AS (SELECT *, (sheet_name, creds, strftime(tanggal, '%Y-%m-%d')) IN ({_CONFIRMED}) AS rec FROM bv)""",
    f"""passed AS (SELECT f.* FROM flagged f LEFT JOIN ({v.MARKS_SQL}) m ON m.creds = f.creds
  WHERE f.rec OR m.mark IS NULL OR f.tanggal > CAST(m.mark AS TIMESTAMP)
  QUALIFY row_number() OVER (PARTITION BY row_hash_raw ORDER BY rec, row_idx) = 1)""",
)

_SILVER_V = ", ".join((*o.SILVER_VIDEO_COLUMNS, *LINEAGE.split(", ")))
_SILVER_P = ", ".join((*o.SILVER_PRODUCTION_COLUMNS, *LINEAGE.split(", ")))

# --- The daily job ---------------------------------------------------------------------------

_PRODUCTION_DATES = {d: d for d in PRODUCTION.date_columns}
_JOBS = {  # dataset: annotated rows, columns whose values are listed, affected columns
    "video": ("av", {**o.NUMERIC, **o.PERCENT, **o.RAW_DATES}, _AFFECTED_NAMES),
    "produksi": (
        "ap",
        _PRODUCTION_DATES,
        "concat_ws('|', CASE WHEN bool_or(bad0) THEN 'tanggal' END, CASE WHEN bool_or(bad1) THEN 'tanggal_jadi' END) AS names",
    ),
}


def _job_values(name: str) -> tuple[str, ...]:
    """Affected columns of each run and the distinct values its error rows hold in them."""
    ann, columns, affected = _JOBS[name]
    cells = " UNION ALL ".join(
        f"SELECT run_no, sheet_name, creds, {_ERR_DATE} AS error_date, '{raw}' AS name, {o.strip(c)} AS bad_value FROM {ann} WHERE is_error"
        for c, raw in columns.items()
    )
    return (
        f"aff_{name} AS (SELECT run_no, {affected} FROM {ann} GROUP BY run_no)",
        f"""vals_{name} AS (SELECT DISTINCT c.run_no, sheet_name, creds, error_date, bad_value FROM ({cells}) c
  JOIN aff_{name} a ON a.run_no = c.run_no AND list_contains(string_split(a.names, '|'), c.name)
  WHERE bad_value IS NOT NULL AND lower(bad_value) NOT IN ('', 'nan', 'none', '-', 'n/a', 'nat'))""",
    )


def _job_entries(name: str) -> tuple[str, ...]:
    """Open entries after the last run: of a key the newest, unless a later run had as many valid rows."""
    ann = _JOBS[name][0]
    return (
        f"""counts_{name} AS (SELECT run_no, sheet_name, creds, strftime(d0, '%Y-%m-%d') AS error_date, count(*) AS n_valid
  FROM {ann} WHERE NOT is_error AND NOT is_blank GROUP BY ALL)""",
        f"""newest_{name} AS (SELECT * FROM (SELECT run_no, sheet_name, creds, {_ERR_DATE} AS error_date, count(*) AS n_rows
  FROM {ann} WHERE is_error GROUP BY ALL) e
  QUALIFY row_number() OVER (PARTITION BY sheet_name, creds, error_date ORDER BY run_no DESC) = 1)""",
        _parts(f"parts_{name}", f"vals_{name}", 10_000, "run_no, "),
    )


_SAME_KEY = "x.sheet_name = e.sheet_name AND x.creds = e.creds AND x.error_date = e.error_date"


def _job_manifest(name: str) -> str:
    return f"""SELECT '{name}' AS dataset, e.sheet_name, e.creds, e.error_date, a.names AS affected_columns, e.n_rows,
  '2024-02-0' || e.run_no || 'T06:00:00' AS reported_at,
  '{name}/date=2024020' || e.run_no || '/run_key=2024020' || e.run_no || '06/run=run' || e.run_no AS path,
  'open' AS status, coalesce(x.part, 0) AS part, coalesce(x.bad_values, '') AS bad_values
  FROM newest_{name} e JOIN aff_{name} a ON a.run_no = e.run_no LEFT JOIN parts_{name} x ON x.run_no = e.run_no AND {_SAME_KEY}
  WHERE NOT EXISTS (SELECT 1 FROM counts_{name} x WHERE x.run_no > e.run_no AND {_SAME_KEY} AND x.n_valid = e.n_rows)"""


# The folder keys of a run.
_RUN_KEYS = "'2024020' || run_no AS date, '2024020' || run_no || '06' AS run_key, 'run' || run_no AS run"


def _job_marks(name: str, loaded: str, sheet: str) -> str:
    rows = " UNION ALL ".join(f"SELECT creds, tanggal, run_no FROM {loaded}{n}" for n in (1, 2, 3))
    return f"""SELECT '{name}' AS dataset, creds, {sheet} AS sheet_name, strftime(max(tanggal), '%Y-%m-%d') AS last_processed_date,
  '2024-02-0' || max(run_no) || 'T06:00:00' AS updated_at FROM ({rows}) u GROUP BY creds"""

ORACLES: dict[str, str] = {
    "parse_mixed_dates": RAW
    + f"SELECT row_idx, {o.date('tanggal')} AS tanggal, {o.date('waktu')} AS waktu FROM rv",
    "date_parse_failures": RAW
    + f"""SELECT {o.strip('tanggal')} AS cell, count(*) AS n_cells FROM rv WHERE {o.date('tanggal')} IS NULL
  AND {o.strip('tanggal')} NOT IN ('', '-', 'nan', 'None', 'NaT') GROUP BY 1""",
    "parse_mixed_days": RAW
    + f"SELECT row_idx, CAST({o.date('tanggal')} AS DATE) AS tanggal, CAST({o.date('waktu')} AS DATE) AS waktu FROM rv",
    "excel_serial_date": RAW
    + f"""SELECT row_idx, CASE WHEN regexp_full_match({o.strip('tanggal')}, '[0-9]{{3,6}}')
  AND CAST(regexp_extract({o.strip('tanggal')}, '^[0-9]+') AS INTEGER) BETWEEN 2 AND 73415
  THEN DATE '1899-12-30' + CAST(regexp_extract({o.strip('tanggal')}, '^[0-9]+') AS INTEGER) END AS serial_date FROM rv""",
    "clean_numeric": RAW
    + "SELECT row_idx, "
    + ", ".join(f"{o.clean_number(c)} AS {c}" for c in NUMERIC)
    + " FROM rv",
    "percent_to_fraction": RAW
    + "SELECT row_idx, "
    + ", ".join(f"{o.fraction(c)} AS {c}" for c in PERCENT)
    + " FROM rv",
    "safe_casts": RAW
    + """SELECT row_idx,
  CASE WHEN regexp_full_match(vv, '[+-]?[0-9]+') THEN TRY_CAST(vv AS BIGINT) END AS vv_long,
  CASE WHEN regexp_full_match(dibagikan, '[+-]?[0-9]+') THEN TRY_CAST(dibagikan AS BIGINT) END AS dibagikan_long,
  CASE WHEN regexp_full_match(vv, '[+-]?[0-9]+[.]?[0-9]*') THEN TRY_CAST(vv AS DECIMAL(38,9)) END AS vv_money,
  CASE WHEN regexp_full_match(komentar, '[+-]?[0-9]+[.]?[0-9]*') THEN TRY_CAST(komentar AS DOUBLE) END AS komentar_double,
  CASE WHEN regexp_full_match(persentase_video_yang_ditonton_hingga_selesai, '[+-]?[0-9]+[.]?[0-9]*')
    THEN TRY_CAST(persentase_video_yang_ditonton_hingga_selesai AS DOUBLE) END AS pct_double FROM rv""",
    "round_half_even": """SELECT l_orderkey, l_linenumber,
  CAST(round_even(CAST(l_quantity / 2 AS DECIMAL(38,9)), 0) AS BIGINT) AS half_quantity,
  CAST(round_even(CAST(l_extendedprice AS DECIMAL(38,9)), 0) AS BIGINT) AS price FROM lineitem""",
    "upper_trim": RAW
    + f"""SELECT row_idx, {o.upper_trim('toko')} AS toko,
  {o.upper_trim('informasi_video')} AS informasi_video FROM rv""",
    "strip_text_hash": f"""SELECT doc_id, CAST(length({o.strip('text')}) AS INTEGER) AS n_chars_stripped,
  {o.sha('lang', o.strip('text'))} AS text_hash FROM documents""",
    "empty_to_null": RAW
    + "SELECT row_idx, "
    + ", ".join(f"nullif({c}, '') AS {c}" for c in VIDEO.text_columns)
    + " FROM rv",
    "profile_integral": W(*ANN)
    + "SELECT "
    + ", ".join(
        f"bool_and({o.clean_number(c)} = floor({o.clean_number(c)})) AS {c}" for c in NUMERIC
    )
    + " FROM av WHERE NOT is_error AND NOT is_blank",
    "sheet_promote_header": _landed(),
    "tag_sources": RAW
    + f"""SELECT r.row_idx, r.id_video, r.sheet_name, s.creds, s.sheet_ord
  FROM rv r LEFT JOIN ({v.SOURCES_SQL}) s ON s.sheet_name = r.sheet_name""",
    "union_sheets": W(o.RAW_VIDEO, o.RAW_PRODUCTION)
    + """SELECT row_idx, toko, produk, sheet_name, NULL AS akun FROM rv
  UNION ALL SELECT row_idx, NULL, produk, sheet_name, akun FROM rp""",
    "ingest_counts": RAW + "SELECT sheet_name, count(*) AS n_rows FROM rv GROUP BY sheet_name",
    "snake_case_columns": RAW + "SELECT * EXCLUDE (run_no) FROM rv",
    "drop_columns": RAW + f"SELECT row_idx, {BRONZE_COLS}, {TAGS} FROM rv",
    "filter_id_present": RAW
    + f"""SELECT row_idx, tanggal AS "Tanggal" FROM rv WHERE tanggal IS NULL OR {o.strip('tanggal')} <> ''""",
    "blank_rows": f"""SELECT row_idx, {o.blank('a')} AND {o.blank('b')} AND {o.blank('c')} AS is_blank
  FROM ({v.BLANK_SQL}) b""",
    "numeric_corruption": RAW + _flagged(o.NUMERIC, o.numeric_corrupt),
    "percent_corruption": RAW + _flagged(o.PERCENT, o.percent_corrupt),
    "date_errors": W(*ANN)
    + "SELECT row_idx, bad0 AS bad_tanggal, bad1 AS bad_waktu FROM av",
    "validate_split": W(*ANN) + f"SELECT row_idx, {_OUTCOME} FROM av",
    "validate_split_production": W(*ANN_P) + f"SELECT row_idx, {_OUTCOME} FROM ap",
    "valid_rows": W(*ANN)
    + "SELECT row_idx, d0 AS tanggal, d1 AS waktu, "
    + ", ".join(
        f"{o.clean_number(c)} AS {c}" if c in NUMERIC else c
        for c in v.VIDEO_CELLS
        if c not in ("tanggal", "waktu")
    )
    + f", {TAGS} FROM av WHERE NOT is_error AND NOT is_blank",
    "error_reason": W(*ANN)
    + f"SELECT row_idx, {o.reason(VIDEO)} AS error_reason FROM av WHERE is_error",
    "quarantine_rows": W(*ANN)
    + f"SELECT row_idx, {', '.join(v.VIDEO_CELLS)}, {TAGS}, {o.reason(VIDEO)} AS error_reason FROM av WHERE is_error",
    "quarantine_rows_production": W(*ANN_P)
    + f"SELECT row_idx, {', '.join(v.PRODUCTION_CELLS)}, {TAGS}, {o.reason(PRODUCTION)} AS error_reason FROM ap WHERE is_error",
    "validation_report": W(*_AFFECTED_SQL)
    + """SELECT bool_or(is_error) AS has_changes, (SELECT names FROM affected) AS affected_columns,
  min(d0) FILTER (corrupt) AS first_affected_date, max(d0) FILTER (corrupt) AS last_affected_date,
  count(*) FILTER (is_error) AS n_bad_rows, count(*) FILTER (bad0 OR bad1) AS n_date_errors,
  count(*) FILTER (is_blank) AS n_blank_rows FROM av""",
    "validation_affected_dates": W(*ANN)
    + "SELECT DISTINCT d0 AS affected_date FROM av WHERE corrupt AND d0 IS NOT NULL",
    "manifest_entries": W(*_FULL_SQL) + "SELECT * FROM full_entries",
    "manifest_json": W(*_FULL_SQL) + "SELECT * FROM full_entries",
    "manifest_bad_values": W(*_VALUES_SQL) + "SELECT * FROM vals",
    "manifest_bad_value_parts": W(*_VALUES_SQL, _PARTS) + "SELECT * FROM parts",
    "manifest_sync": W(*_FULL_SQL, _COUNTS, _OPEN, _CLASSIFIED)
    + f"""SELECT * FROM full_entries
  UNION ALL SELECT {_ENTRY_COLS}, 0, 'a|b' FROM classified WHERE outcome = 'kept'
  UNION ALL SELECT {_ENTRY_COLS}, 1, 'c' FROM classified WHERE outcome = 'kept' AND error_date = 'INVALID_DATE'""",
    "manifest_fixes": W(*_SYNC_SQL)
    + f"""SELECT sheet_name, creds, error_date, affected_columns, '{REPORTED_AT}' AS resolved_at,
  path, 'fixed' AS status FROM classified WHERE outcome = 'resolved'""",
    "recovery_confirmed": W(*_OPEN_SQL) + _CONFIRMED,
    "recovery_select": W(*_OPEN_SQL) + _recovered(True),
    "recovery_remainder": W(*_OPEN_SQL) + _recovered(False),
    "recovery_counters": W(*_OPEN_SQL)
    + """SELECT count(*) AS recovery_resolved,
  CAST(coalesce(sum(n_valid) FILTER (n_valid = n_rows), 0) AS BIGINT) AS recovery_recovered_rows,
  count(*) FILTER (n_valid <> n_rows) AS recovery_count_mismatch,
  count(*) FILTER (n_valid IS NULL) AS recovery_absent
  FROM opened p LEFT JOIN counts c USING (sheet_name, creds, error_date)""",
    "watermark_read_migrate": W(*_STATE)
    + """SELECT coalesce(nullif(s.creds, ''), r.creds, s.sheet_name) AS creds,
  max(substr(trim(last_processed_date), 1, 10)) AS mark
  FROM st s LEFT JOIN reg r ON r.sheet_name = s.sheet_name GROUP BY 1""",
    "watermark_update": W(*_STATE, _MIGRATED)
    + """SELECT coalesce(f.creds, o.creds) AS creds,
  CASE WHEN f.creds IS NULL THEN o.sheet_name ELSE coalesce(b.name, o.sheet_name, f.creds) END AS sheet_name,
  coalesce(f.max_date, o.last_processed_date) AS last_processed_date,
  CASE WHEN f.creds IS NULL THEN o.updated_at ELSE '2024-02-01T06:00:00' END AS updated_at
  FROM old o FULL OUTER JOIN fresh f ON f.creds = o.creds LEFT JOIN by_creds b ON b.creds = f.creds""",
    "watermark_filter": W(*ANN, _MARKED) + "SELECT * FROM marked",
    "watermark_max_dates": W(*ANN, _MARKED)
    + "SELECT creds, strftime(max(tanggal), '%Y-%m-%d') AS max_date FROM marked GROUP BY creds",
    "watermark_marked_day": W(*o.BRONZE_VIDEO)
    + f"""SELECT row_idx, b.creds, tanggal, row_hash_raw FROM bv b LEFT JOIN ({v.MARKS_SQL}) m ON m.creds = b.creds
  WHERE run_no = 2 AND (m.mark IS NULL OR tanggal >= CAST(m.mark AS TIMESTAMP) + INTERVAL 1 DAY
    OR (tanggal >= CAST(m.mark AS TIMESTAMP) AND row_hash_raw NOT IN (SELECT row_hash_raw FROM bv WHERE run_no = 1)))""",
    "row_hash_raw_video": W(*o.BRONZE_VIDEO) + "SELECT row_idx, run_id, row_hash_raw FROM bv",
    "row_hash_raw_production": W(*o.BRONZE_PRODUCTION)
    + "SELECT row_idx, run_id, row_hash_raw FROM bp",
    "bronze_video": W(*o.BRONZE_VIDEO)
    + f"SELECT row_idx, {BRONZE_COLS}, {TAGS}, {LINEAGE} FROM bv",
    "bronze_production": W(*o.BRONZE_PRODUCTION)
    + f"SELECT row_idx, {BRONZE_COLS_P}, {TAGS}, {LINEAGE} FROM bp",
    "bronze_batch": W(*_BATCH)
    + f"SELECT {BRONZE_COLS}, {TAGS}, {LINEAGE} FROM passed",
    "dedupe_row_hash": W(*o.BRONZE_PRODUCTION)
    + """SELECT row_hash_raw, run_id, row_idx FROM bp
  QUALIFY row_number() OVER (PARTITION BY row_hash_raw ORDER BY run_id, row_idx) = 1""",
    "latest_video": W(*o.LATEST_VIDEO)
    + f"SELECT row_idx, {BRONZE_COLS}, {TAGS}, {LINEAGE} FROM lv",
    "latest_production": W(*o.LATEST_PRODUCTION)
    + f"SELECT row_idx, {BRONZE_COLS_P}, {TAGS}, {LINEAGE} FROM lp",
    "silver_video_base": W(*o.SILVER_VIDEO) + f"SELECT {_SILVER_V} FROM svb",
    "silver_production_base": W(*o.SILVER_PRODUCTION) + f"SELECT {_SILVER_P} FROM spb",
    "row_hash_clean_video": W(*o.SILVER_VIDEO)
    + "SELECT tanggal, toko, id_kreator, id_video, row_hash_clean FROM sv",
    "row_hash_clean_production": W(*o.SILVER_PRODUCTION)
    + "SELECT tanggal, akun, id_konten, row_hash_clean FROM sp",
    "merge_video": W(*o.MERGE_VIDEO) + f"SELECT *, {SNAPSHOT_TS} FROM mv",
    "merge_production": W(*o.MERGE_PRODUCTION) + f"SELECT *, {SNAPSHOT_TS} FROM mp",
    "merge_actions": W(*o.MERGE_VIDEO, *o.MERGE_PRODUCTION)
    + """SELECT action, count(*) AS n_rows, 'video' AS table_name FROM mv GROUP BY action
  UNION ALL SELECT action, count(*), 'production' FROM mp GROUP BY action""",
    "production_dedup": W(*o.SILVER_PRODUCTION, o.DEDUP)
    + f"SELECT {_SILVER_P}, row_hash_clean FROM dim",
    "gold_fact": W(*o.SILVER_VIDEO, *o.SILVER_PRODUCTION, o.DEDUP)
    + f"SELECT {o.GOLD_SELECT} FROM sv a LEFT JOIN dim b ON a.id_video = b.id_konten",
    "daily_job_bronze": W(*o.JOB_BRONZE_VIDEO, *o.JOB_BRONZE_PRODUCTION)
    + f"""SELECT 'video' AS dataset, tanggal, {TAGS}, {LINEAGE} FROM bv
  UNION ALL SELECT 'produksi', tanggal, {TAGS}, {LINEAGE} FROM bp""",
    "daily_job_silver_video": W(*o.JOB_SILVER_VIDEO) + f"SELECT {_SILVER_V}, row_hash_clean FROM vm3",
    "daily_job_silver_production": W(*o.JOB_SILVER_PRODUCTION)
    + f"SELECT {_SILVER_P}, row_hash_clean FROM pm3",
    "daily_job_gold": W(
        *o.JOB_SILVER_VIDEO, *o.JOB_SILVER_PRODUCTION, "sp AS (SELECT * FROM pm3)", o.DEDUP
    )
    + f"SELECT {o.GOLD_SELECT} FROM vm3 a LEFT JOIN dim b ON a.id_video = b.id_konten",
    "daily_job_manifest": W(
        *o.JOB_ANN_VIDEO, o.RUNS_PRODUCTION, o.ANN_PRODUCTION,
        *[part for name in _JOBS for part in (*_job_values(name), *_job_entries(name))],
    )
    + " UNION ALL ".join(_job_manifest(name) for name in _JOBS),
    "daily_job_watermarks": W(*o.JOB_BRONZE_VIDEO, *o.JOB_BRONZE_PRODUCTION)
    + _job_marks("video", "bv", "CASE WHEN creds = 'cred3' THEN 'sheet4' ELSE 'sheet' || substr(creds, 5) END")
    + " UNION ALL "
    + _job_marks("produksi", "bp", "'produksi'"),
    "daily_job_quarantine": W(*o.JOB_ANN_VIDEO, o.RUNS_PRODUCTION, o.ANN_PRODUCTION)
    + f"""SELECT 'video' AS dataset, row_idx + 3 AS row_idx, {TAGS}, {o.reason(VIDEO)} AS error_reason, {_RUN_KEYS} FROM av WHERE is_error
  UNION ALL SELECT 'produksi', row_idx + 1, {TAGS}, {o.reason(PRODUCTION)}, {_RUN_KEYS} FROM ap WHERE is_error""",
    "daily_job_values": W(
        *o.JOB_ANN_VIDEO, o.RUNS_PRODUCTION, o.ANN_PRODUCTION, *[part for name in _JOBS for part in _job_values(name)]
    )
    + " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, sheet_name, creds, error_date, bad_value, {_RUN_KEYS} FROM vals_{name}" for name in _JOBS
    ),
    "daily_job_landed": W(*o.JOB_BRONZE_VIDEO, *o.JOB_BRONZE_PRODUCTION)
    + f"""SELECT 'video' AS dataset, tanggal, creds, row_hash_raw, {_RUN_KEYS} FROM bv
  UNION ALL SELECT 'produksi', tanggal, creds, row_hash_raw, {_RUN_KEYS} FROM bp""",
}
