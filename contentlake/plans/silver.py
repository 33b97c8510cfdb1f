"""Silver: latest snapshot per business key, typed and trimmed, with a clean hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from contentlake.functions.dates import day_text, second_text
from contentlake.functions.hashes import row_hash
from contentlake.functions.numbers import (
    MONEY,
    percent_to_fraction,
    plain_number,
    safe_long,
    safe_money,
)
from contentlake.functions.text import or_empty, strip, upper_trim
from contentlake.operators.latest import latest_production, latest_video
from contentlake.specs import (
    LINEAGE,
    PRODUCTION_HASH_COLUMNS,
    SILVER_PRODUCTION_COLUMNS,
    SILVER_VIDEO_COLUMNS,
    SILVER_VIDEO_COUNTS,
    SILVER_VIDEO_MONEY,
    SILVER_VIDEO_RATIOS,
)

_LINEAGE_TYPES = "snapshot_ts timestamp, snapshot_date date, run_id string, row_hash_raw string"


def _ddl(columns: tuple[str, ...], types: dict[str, str]) -> str:
    business = ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)
    return f"{business}, {_LINEAGE_TYPES}, row_hash_clean string"


SILVER_VIDEO_SCHEMA = _ddl(
    SILVER_VIDEO_COLUMNS,
    {
        "tanggal": "date",
        "waktu": "timestamp_ntz",
        **{c: "bigint" for c in SILVER_VIDEO_COUNTS.values()},
        **{c: MONEY for c in SILVER_VIDEO_MONEY.values()},
        **{c: "double" for c in SILVER_VIDEO_RATIOS.values()},
    },
)
SILVER_PRODUCTION_SCHEMA = _ddl(
    SILVER_PRODUCTION_COLUMNS, {"tanggal": "timestamp_ntz", "tanggal_jadi": "timestamp_ntz"}
)


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NumericType)


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def silver_video_base(latest: DataFrame, decimal_comma: bool = False) -> DataFrame:
    cells = {c: upper_trim(c) for c in SILVER_VIDEO_COLUMNS}
    cells |= {"tanggal": "to_date(tanggal)", "waktu": "waktu"}
    for raw, name in SILVER_VIDEO_COUNTS.items():
        cells[name] = f"CAST({raw} AS bigint)" if _is_number(latest, raw) else safe_long(raw)
    for raw, name in SILVER_VIDEO_MONEY.items():
        as_money = f"try_cast({raw} AS {MONEY})"
        cells[name] = as_money if _is_number(latest, raw) else safe_money(raw)
    for raw, name in SILVER_VIDEO_RATIOS.items():
        cells[name] = percent_to_fraction(raw, decimal_comma)
    return latest.selectExpr(*[f"{e} AS {c}" for c, e in cells.items()], *_lineage(latest))


def silver_production_base(latest: DataFrame) -> DataFrame:
    cells = {c: upper_trim(c) for c in SILVER_PRODUCTION_COLUMNS}
    cells |= {
        "tanggal": "CAST(tanggal AS timestamp_ntz)",
        "tanggal_jadi": "CAST(tanggal_jadi AS timestamp_ntz)",
        "link_konten": strip("link_konten"),  # links keep their case
    }
    return latest.selectExpr(*[f"{e} AS {c}" for c, e in cells.items()], *_lineage(latest))


def row_hash_clean_video() -> str:
    """A null toko, waktu or number drops out together with its separator."""
    text = ("id_kreator", "id_video", "nama_kreator", "informasi_video", "produk")
    counts = SILVER_VIDEO_COUNTS.values()
    # Doubles go through decimal(38,9): their own text form differs between engines.
    fractional = (*SILVER_VIDEO_MONEY.values(), *SILVER_VIDEO_RATIOS.values())
    return row_hash(
        day_text("tanggal"),
        "toko",
        *[or_empty(c) for c in text],
        second_text("waktu"),
        *[f"CAST({c} AS string)" for c in counts],
        *[plain_number(c) for c in fractional],
    )


def row_hash_clean_production() -> str:
    """A null date or akun drops out together with its separator."""
    special = {
        "tanggal": second_text("tanggal"),
        "tanggal_jadi": second_text("tanggal_jadi"),
        "akun": "akun",
    }
    return row_hash(*[special.get(c, or_empty(c)) for c in PRODUCTION_HASH_COLUMNS])


def silver_video(bronze: DataFrame, decimal_comma: bool = False) -> DataFrame:
    """Merge source of the video table: one row per key."""
    base = silver_video_base(latest_video(bronze), decimal_comma)
    return base.withColumn("row_hash_clean", F.expr(row_hash_clean_video()))


def silver_production(bronze: DataFrame) -> DataFrame:
    """Merge source of the production table: one row per key and day."""
    base = silver_production_base(latest_production(bronze))
    return base.withColumn("row_hash_clean", F.expr(row_hash_clean_production()))


def changed_since(bronze: DataFrame, unmatched: DataFrame, since) -> DataFrame:
    """Bronze rows a merge can still act on: snapshots from day `since` on, and the rows
    whose null key matches nothing and which every merge inserts again.

    `unmatched` holds the latter in a table of their own (all rows of bronze with a null key), so bronze
    is read from its partitions of `since` and later alone. The result of the merge is that of
    reading all of bronze: for any other key the newest snapshot is the one already merged,
    with the same hash.
    """
    if since is None:
        return bronze
    day = F.lit(since)
    recent = bronze.filter(F.col("snapshot_date") >= day)
    return recent.unionByName(unmatched.filter(F.col("snapshot_date") < day))
