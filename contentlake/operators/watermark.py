"""Per-source high-water marks: read and migrate, filter, maxima, update.

State rows: creds, sheet_name, last_processed_date, updated_at (all strings) and
`ord`, the position in the state file. Registry rows: sheet_name, creds, sheet_ord.
State and registry are joined without a hint: Spark broadcasts them while their
size is under its threshold and shuffles (with skew splitting) beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATE_SCHEMA = (
    "creds string, sheet_name string, last_processed_date string, updated_at string, ord bigint"
)
REGISTRY_SCHEMA = "sheet_name string, creds string, sheet_ord int"


def _text(c: Column) -> Column:
    """Null for the empty text, so that `coalesce` skips it."""
    return F.nullif(c, F.lit(""))


def _creds_by_name(registry: DataFrame) -> DataFrame:
    return registry.select(F.col("sheet_name").alias("_name"), F.col("creds").alias("_reg_creds"))


def _name_by_creds(registry: DataFrame) -> DataFrame:
    """Of several names with one creds the last in registry order counts."""
    return registry.groupBy(F.col("creds").alias("_creds")).agg(
        F.max_by("sheet_name", "sheet_ord").alias("_reg_name")
    )


def _by_name(state: DataFrame, registry: DataFrame) -> DataFrame:
    return state.join(
        _creds_by_name(registry), F.col("sheet_name") == F.col("_name"), "left"
    ).drop("_name")


def watermark_map(state: DataFrame, registry: DataFrame) -> DataFrame:
    """(creds, mark): newest day per source. A row without creds is translated by the
    registry; if that fails its own sheet name is the key."""
    creds = F.coalesce(_text(F.col("creds")), _text(F.col("_reg_creds")), F.col("sheet_name"))
    return (
        _by_name(state, registry)
        .groupBy(creds.alias("creds"))
        .agg(F.max(F.substring(F.trim("last_processed_date"), 1, 10)).alias("mark"))
    )


def _with_cutoff(df: DataFrame, marks: DataFrame, group: str) -> DataFrame:
    """`df` with the mark of its source as a time, `_cutoff`."""
    m = marks.select(F.col("creds").alias("_source"), _text(F.col("mark")).try_cast("timestamp_ntz").alias("_cutoff"))
    return df.join(m, F.col(group) == F.col("_source"), "left").drop("_source")


def filter_by_watermark(
    df: DataFrame,
    marks: DataFrame,
    group: str = "creds",
    date: str = "tanggal",
    bypass: Column | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows later than the mark of their source; a source without a mark is loaded in
    full, and so are rows without a source, and all rows of a table without that column.
    `bypass` rows pass whatever their date.

    `inclusive` also keeps the start of the marked day itself, for use with a later dedupe.
    """
    if group not in df.columns:
        return df
    cutoff, ts = F.col("_cutoff"), F.col(date).cast("timestamp_ntz")
    later = (ts >= cutoff) if inclusive else (ts > cutoff)
    keep = cutoff.isNull() | F.coalesce(later, F.lit(False))
    if bypass is not None:
        keep = keep | bypass
    return _with_cutoff(df, marks, group).filter(keep).drop("_cutoff")


def filter_marked_day(
    df: DataFrame,
    marks: DataFrame,
    loaded: DataFrame,
    group: str = "creds",
    date: str = "tanggal",
    row_hash: str = "row_hash_raw",
    bypass: Column | None = None,
) -> DataFrame:
    """As `filter_by_watermark`, but a row of the marked day passes if, and only if, no row of `loaded`
    has its hash: what arrives late on that day is not lost, and what was loaded from it
    is not loaded again.

    `loaded` needs the hashes of the marked days only. Rows past the marked day are not compared
    and not shuffled for it.
    """
    if group not in df.columns:
        return df
    cutoff, ts = F.col("_cutoff"), F.col(date).cast("timestamp_ntz")
    marked = _with_cutoff(df, marks, group)
    past = cutoff.isNull() | F.coalesce(ts >= cutoff + F.expr("INTERVAL 1 DAY"), F.lit(False))
    if bypass is not None:
        past = past | bypass
    on_day = marked.filter(~past & (ts >= cutoff))
    fresh = on_day.join(loaded.select(row_hash), row_hash, "left_anti")
    return marked.filter(past).unionByName(fresh).drop("_cutoff")


def earliest_mark(marks: DataFrame) -> str | None:
    """The least mark, from which `loaded` of `filter_marked_day` has to be read."""
    return marks.agg(F.min(_text(F.col("mark"))).alias("mark")).first()["mark"]


def max_dates(df: DataFrame, group: str = "creds", date: str = "tanggal") -> DataFrame:
    """(creds, max_date) over kept rows; sources and dates that are null have none."""
    return (
        df.filter(F.col(group).isNotNull() & F.col(date).isNotNull())
        .groupBy(F.col(group).alias("creds"))
        .agg(F.date_format(F.max(date), "yyyy-MM-dd").alias("max_date"))
    )


def migrate_state(state: DataFrame, registry: DataFrame) -> DataFrame:
    """Old-format rows get their creds, unknown creds are resolved again by name, and
    of rows that then share a creds the newest (last, if equal) stays."""
    known = _name_by_creds(registry)
    joined = _by_name(state, registry).join(known, F.col("creds") == F.col("_creds"), "left")
    own = _text(F.col("creds"))
    by_name = F.when(_text(F.col("sheet_name")).isNotNull(), _text(F.col("_reg_creds")))
    creds = (
        F.when(own.isNull(), F.coalesce(by_name, F.col("sheet_name")))
        .when(F.col("_creds").isNull(), F.coalesce(by_name, own))
        .otherwise(own)
    )
    keyed = joined.select(
        creds.alias("creds"),
        "sheet_name",
        "last_processed_date",
        F.coalesce("updated_at", F.lit("")).alias("updated_at"),
        "ord",
    )
    named = keyed.join(known, F.col("creds") == F.col("_creds"), "left").select(
        "creds",
        F.coalesce(_text(F.col("_reg_name")), _text(F.col("sheet_name")), F.col("creds")).alias(
            "sheet_name"
        ),
        "last_processed_date",
        "updated_at",
        "ord",
    )
    newest = Window.partitionBy("creds").orderBy(F.desc("updated_at"), F.desc("ord"))
    return named.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn", "ord")


def update_watermarks(
    state: DataFrame, fresh: DataFrame, registry: DataFrame, now: str
) -> DataFrame:
    """New state: fresh maxima win and get `now`; other rows keep their old stamp."""
    old = migrate_state(state, registry)
    f = fresh.select(F.col("creds").alias("_f_creds"), "max_date")
    reg = _name_by_creds(registry)
    joined = old.join(f, F.col("creds") == F.col("_f_creds"), "full_outer").join(
        reg, F.col("_f_creds") == F.col("_creds"), "left"
    )
    is_fresh = F.col("_f_creds").isNotNull()
    return joined.select(
        F.coalesce("_f_creds", "creds").alias("creds"),
        F.when(
            is_fresh,
            F.coalesce(_text(F.col("_reg_name")), _text(F.col("sheet_name")), F.col("_f_creds")),
        )
        .otherwise(F.col("sheet_name"))
        .alias("sheet_name"),
        F.when(is_fresh, F.col("max_date"))
        .otherwise(F.col("last_processed_date"))
        .alias("last_processed_date"),
        F.when(is_fresh, F.lit(now)).otherwise(F.col("updated_at")).alias("updated_at"),
    )
