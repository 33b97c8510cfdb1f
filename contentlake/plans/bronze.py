"""Bronze: validated rows to snapshot rows with a raw hash."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType

from contentlake.functions.dates import parse_mixed_dates, second_text
from contentlake.functions.hashes import row_hash
from contentlake.functions.numbers import MONEY, clean_number, plain_number, round_half_even
from contentlake.functions.text import canon, empty_to_null, has_id, or_empty, q, snake_case
from contentlake.operators.latest import first_by_hash
from contentlake.operators.naming import drop_columns, snake_case_columns
from contentlake.operators.validate import present
from contentlake.operators.watermark import filter_by_watermark, filter_marked_day
from contentlake.specs import ORDINAL, TAGS, DatasetSpec


def utc(ts: datetime) -> datetime:
    return ts.astimezone(timezone.utc) if ts.tzinfo else ts.replace(tzinfo=timezone.utc)


def date_keys(ts: datetime) -> tuple[str, str]:
    """(YYYYMMDD, YYYYMMDDHH) of a run."""
    t = utc(ts)
    return t.strftime("%Y%m%d"), t.strftime("%Y%m%d%H")


def _typed(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Dates parsed if they still are text (parsing twice changes nothing)."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.withColumns(
        {d: F.expr(parse_mixed_dates(q(d))) for d in spec.date_columns if d in text}
    )


def hash_part(df: DataFrame, name: str) -> str:
    """Canonical text of one hash input: fixed per type, whatever the batch holds."""
    kind = df.schema[name].dataType
    if isinstance(kind, StringType):
        return canon(q(name))
    if isinstance(kind, DecimalType):
        return or_empty(plain_number(q(name)))
    return or_empty(second_text(q(name)))


def row_hash_raw(df: DataFrame, spec: DatasetSpec) -> str:
    return row_hash(*[hash_part(df, c) for c in spec.hash_columns])


def _whole(df: DataFrame, name: str) -> str:
    is_text = isinstance(df.schema[name].dataType, StringType)
    return round_half_even(clean_number(q(name)) if is_text else q(name))


def build_bronze(
    valid: DataFrame, spec: DatasetSpec, run_ts: datetime, run_id: str
) -> DataFrame:
    """Snapshot rows of one run. Stamps are arguments, so a repeated run gives the same rows."""
    df = _typed(snake_case_columns(valid), spec)
    if spec.id_column not in spec.date_columns:
        df = df.filter(has_id(q(spec.id_column)))
    df = drop_columns(df, spec.drop_columns)
    if spec.empty_text_is_null:
        text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
        df = df.selectExpr(
            *[f"{empty_to_null(q(c))} AS {q(c)}" if c in text else q(c) for c in df.columns]
        )

    counts = set(present(df, spec.count_columns))
    stamp = utc(run_ts)
    return df.select(
        *[F.expr(f"{_whole(df, c)} AS {q(c)}" if c in counts else q(c)) for c in df.columns],
        F.lit(stamp).alias("snapshot_ts"),
        F.lit(stamp.date()).alias("snapshot_date"),
        F.lit(run_id).alias("run_id"),
        F.expr(row_hash_raw(df, spec)).alias("row_hash_raw"),
    )


def loadable(bronze: DataFrame, marks: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Rows past the mark of their source, and recovered rows whatever their date.

    With `loaded`, the bronze rows of the marked days, also rows of those days that are not among them.
    """
    if loaded is not None:
        return filter_marked_day(bronze, marks, loaded, bypass=F.col("is_recovered"))
    return filter_by_watermark(bronze, marks, bypass=F.col("is_recovered"))


def first_rows(passed: DataFrame) -> DataFrame:
    """Of loadable rows with equal hash the first, regular before recovered."""
    order = [F.asc("is_recovered"), *[F.asc(o) for o in ORDINAL if o in passed.columns]]
    return first_by_hash(passed, order).drop("is_recovered", *ORDINAL)


def bronze_batch(bronze: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows to load."""
    return first_rows(loadable(bronze, marks))


def bronze_schema(spec: DatasetSpec) -> str:
    """The bronze columns silver reads; a column a run did not have reads as null."""
    renamed = {snake_case(c): MONEY for c in spec.numeric_columns}
    renamed |= {snake_case(c): "string" for c in spec.percent_columns}
    renamed |= {c: "bigint" for c in spec.count_columns}
    types = {d: "timestamp_ntz" for d in spec.date_columns}
    types |= {c: "string" for c in spec.text_columns} | renamed | {c: "string" for c in TAGS}
    business = ", ".join(f"`{c}` {t}" for c, t in types.items())
    return (
        f"{business}, snapshot_ts timestamp, row_hash_raw string, "
        "snapshot_date date, run_id string"
    )
