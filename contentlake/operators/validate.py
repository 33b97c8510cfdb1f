"""Row validation: flags in one projection, then a three-way split.

`annotate` adds to each raw row

* ``_corrupt``, ``_cells_<w>``     a numeric/percent cell is corrupt, and which: bit i of word w,
* ``_undated``, ``_undated_<w>``   a date cell is an error, and which,
* ``_blank``                       every non-tag cell is blank,
* ``_date_<i>``                    the parsed date of date column i.

Error flags are bitmaps of as many 62-bit words as there are columns to check, so that the
affected columns of a batch are one `bit_or` per word, with nothing collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.functions.dates import is_date_token, parse_mixed_dates
from contentlake.functions.numbers import clean_number, is_numeric_corrupt, is_percent_corrupt
from contentlake.functions.text import has_id, is_blank, is_non_empty, literal, q, strip
from contentlake.operators.naming import find_column
from contentlake.specs import ERROR_REASON, ORDINAL, TAGS, DatasetSpec

IS_ERROR = "((_corrupt OR _undated) AND NOT _blank)"
IS_VALID = "(NOT _blank AND NOT _corrupt AND NOT _undated)"
WORD_BITS = 62
_CELLS, _DATES = "_cells", "_undated"


def present(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [n for n in names if n in df.columns]


def date_names(df: DataFrame, spec: DatasetSpec) -> list[str]:
    return [find_column(df, d) for d in spec.date_columns]


def checked_cells(df: DataFrame, spec: DatasetSpec) -> list[str]:
    """Numeric then percent columns, the bit order of ``_cells_<w>``."""
    return present(df, spec.numeric_columns) + present(df, spec.percent_columns)


def _words(name: str, flags: list[str]) -> list[str]:
    """The bitmap of `flags`, one column per word; at least one."""
    out = []
    for w, at in enumerate(range(0, max(len(flags), 1), WORD_BITS)):
        bits = [f"if({flag}, {1 << i}L, 0L)" for i, flag in enumerate(flags[at : at + WORD_BITS])]
        out.append(f"{' | '.join(['0L', *bits])} AS {name}_{w}")
    return out


def _word_names(name: str, n_flags: int) -> list[str]:
    return [f"{name}_{w}" for w in range(max(1, -(-n_flags // WORD_BITS)))]


def _any_bit(name: str, n_flags: int) -> str:
    return f"({' OR '.join(f'{w} <> 0' for w in _word_names(name, n_flags))})"


def has_bit(name: str, i: int) -> str:
    """Bit i of the bitmap `name` is set in a row."""
    return f"({name}_{i // WORD_BITS} & {1 << i % WORD_BITS}L) <> 0"


def _names_of(name: str, names: list[str]) -> str:
    """Aggregate: SQL array of the names whose bit is set in any row."""
    hits = [
        f"if((bit_or({name}_{i // WORD_BITS}) & {1 << i % WORD_BITS}L) <> 0, {literal(n)}, NULL)"
        for i, n in enumerate(names)
    ]
    return f"array_compact(array({', '.join(hits)}))" if hits else "cast(array() as array<string>)"


def rows_with_id(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return df.filter(has_id(q(find_column(df, spec.id_column))))


def blank_row(df: DataFrame, extra_tags: tuple[str, ...] = ()) -> str:
    """True when every column that is not a tag is blank."""
    ignore = {*TAGS, *ORDINAL, ERROR_REASON, *extra_tags}
    cells = [is_blank(q(c)) for c in df.columns if c not in ignore]
    return f"({' AND '.join(cells)})" if cells else "false"


def annotate(df: DataFrame, spec: DatasetSpec, extra_tags: tuple[str, ...] = ()) -> DataFrame:
    dates = date_names(df, spec)
    cells = [is_numeric_corrupt(q(c)) for c in present(df, spec.numeric_columns)]
    cells += [is_percent_corrupt(q(c)) for c in present(df, spec.percent_columns)]
    parsed = df.selectExpr(
        "*",
        *_words(_CELLS, cells),
        f"{blank_row(df, extra_tags)} AS _blank",
        *[f"{parse_mixed_dates(q(d))} AS _date_{i}" for i, d in enumerate(dates)],
    )
    # A missing primary date is always an error, a secondary one only if its cell
    # holds content.
    failed = [
        f"_date_{i} IS NULL" + (f" AND {is_non_empty(q(d))}" if i else "")
        for i, d in enumerate(dates)
    ]
    return parsed.selectExpr(
        "*",
        f"{_any_bit(_CELLS, len(cells))} AS _corrupt",
        f"({' OR '.join(f'({x})' for x in failed) or 'false'}) AS _undated",
        *_words(_DATES, failed),
    )


def helper_columns(df: DataFrame, spec: DatasetSpec) -> list[str]:
    n_dates = len(spec.date_columns)
    return [
        "_blank",
        "_corrupt",
        "_undated",
        *_word_names(_CELLS, len(checked_cells(df, spec))),
        *_word_names(_DATES, n_dates),
        *[f"_date_{i}" for i in range(n_dates)],
    ]


def error_reason(dates: list[str]) -> str:
    failed = [
        f"if({has_bit(_DATES, i)}, "
        f"concat({literal(f'date_unparsable({d}=')}, coalesce({q(d)}, 'nan'), ')'), NULL)"
        for i, d in enumerate(dates)
    ]
    return f"concat_ws('|', if(_corrupt, 'numeric_mixed', NULL), {', '.join(failed)})"


def valid_rows(annotated: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Valid rows: numbers as decimal(38,9), dates parsed, all else untouched."""
    numeric = set(present(annotated, spec.numeric_columns))
    parsed = {d: f"_date_{i}" for i, d in enumerate(date_names(annotated, spec))}
    helpers = set(helper_columns(annotated, spec))

    def cell(name: str) -> str:
        if name in parsed:
            return f"{parsed[name]} AS {q(name)}"
        if name in numeric:
            return f"{clean_number(q(name))} AS {q(name)}"
        return q(name)

    return annotated.filter(IS_VALID).selectExpr(
        *[cell(c) for c in annotated.columns if c not in helpers]
    )


def error_rows(annotated: DataFrame, spec: DatasetSpec, keep_date: bool = False) -> DataFrame:
    """Quarantine rows: the raw cells plus `error_reason` (and the parsed primary date)."""
    helpers = set(helper_columns(annotated, spec))
    raw = [q(c) for c in annotated.columns if c not in helpers]
    reason = error_reason(date_names(annotated, spec))
    return annotated.filter(IS_ERROR).selectExpr(
        *raw, *(["_date_0"] if keep_date else []), f"{reason} AS {ERROR_REASON}"
    )


def affected_columns(annotated: DataFrame, spec: DatasetSpec) -> str:
    """Aggregate: names of all columns with a flagged cell, numeric, percent, dates."""
    cells = _names_of(_CELLS, checked_cells(annotated, spec))
    dates = _names_of(_DATES, date_names(annotated, spec))
    return f"concat({cells}, {dates})"


def affected_list(annotated: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The batch-wide affected columns as one row holding one array."""
    return annotated.selectExpr(f"{affected_columns(annotated, spec)} AS affected_columns")


def report_metrics(annotated: DataFrame, spec: DatasetSpec) -> dict[str, str]:
    """The counters of the report, each a partial aggregate with a state of fixed size."""
    return {
        "has_changes": f"coalesce(bool_or({IS_ERROR}), false)",
        "affected_columns": f"coalesce({affected_columns(annotated, spec)}, cast(array() AS array<string>))",
        "first_affected_date": "min(if(_corrupt, _date_0, NULL))",
        "last_affected_date": "max(if(_corrupt, _date_0, NULL))",
        "n_bad_rows": f"count_if({IS_ERROR})",
        "n_date_errors": "count_if(_undated)",
        "n_blank_rows": "count_if(_blank)",
    }


REPORT_SCHEMA = (
    "has_changes boolean, affected_columns array<string>, first_affected_date timestamp_ntz, "
    "last_affected_date timestamp_ntz, n_bad_rows bigint, n_date_errors bigint, n_blank_rows bigint"
)


def validation_report(annotated: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row of counters."""
    return annotated.selectExpr(*[f"{e} AS {n}" for n, e in report_metrics(annotated, spec).items()])


def affected_dates(annotated: DataFrame) -> DataFrame:
    """Distinct dates of rows with a corrupt cell, one per row rather than in one array."""
    return (
        annotated.filter(F.col("_corrupt") & F.col("_date_0").isNotNull())
        .select(F.col("_date_0").alias("affected_date"))
        .distinct()
    )


def unparsable_dates(df: DataFrame, date: str) -> DataFrame:
    """(cell, n_cells): every distinct text of a date column that was meant as a date and is none."""
    c = q(date)
    return (
        df.filter(f"{is_date_token(c)} AND {parse_mixed_dates(c)} IS NULL")
        .groupBy(F.expr(strip(c)).alias("cell"))
        .agg(F.count("*").alias("n_cells"))
    )


def is_integral(c: str) -> str:
    """Aggregate: every value is whole. A profile only; it never changes a type."""
    return f"coalesce(bool_and({c} % 1 = 0), true)"
