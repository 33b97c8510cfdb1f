"""Mixed-format dates from spreadsheet cells."""

from __future__ import annotations

from contentlake.functions.text import WS_CLASS, literal, matches, strip

# Cell texts that mean "no date" and are not parse failures.
DATE_NULL_TOKENS = ("", "-", "nan", "None", "NaT")

EXCEL_DAY_ZERO = "1899-12-30"
FIRST_SERIAL, LAST_SERIAL = 2, 73415  # 1900-01-01 and 2100-12-31

INVALID_DATE = "INVALID_DATE"

_YEAR = "(19[0-9]{2}|20[0-9]{2}|2100)"  # the accepted year window
_NN = "([0-9]{1,2})"
_SEP = "[-./]"
_PAD = f"[{WS_CLASS}]*"
_GAP = f"[{WS_CLASS}]+"


def _fill(forms: str) -> str:
    """Pattern that always takes the whole cell: one of `forms` fills the groups, any
    other cell goes to the last branch and leaves them empty, which is no date."""
    return rf"(?s)^(?:{_PAD}(?:{forms}){_PAD}|.*)\z"


_LONG_YEAR = _fill(
    rf"{_YEAR}{_SEP}{_NN}{_SEP}{_NN}"
    rf"|{_YEAR}/{_NN}/{_NN}{_GAP}([0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}})"
    rf"|{_YEAR}-{_NN}-{_NN}{_GAP}([0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}})"
    rf"|{_NN}{_SEP}{_NN}{_SEP}{_YEAR}"
)
_LONG_YEAR_TEXT = "$1$4$8$14-$2$5$9$13-$3$6$10$12 $7$11"
# Usual cells of the same forms, read without capturing: year first (with a time or not), and year last.
_YEAR_FIRST = (
    r"^(?:19[0-9]{2}|20[0-9]{2}|2100)(?:[-./][0-9]{1,2}[-./][0-9]{1,2}"
    r"|/[0-9]{1,2}/[0-9]{1,2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}|-[0-9]{1,2}-[0-9]{1,2} [0-9]{2}:[0-9]{2}:[0-9]{2})\z"
)
_YEAR_LAST = r"^[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19[0-9]{2}|20[0-9]{2}|2100)\z"
_YEAR_20XX = _fill(rf"{_NN}{_SEP}{_NN}{_SEP}([0-5][0-9]|6[0-8])")
_YEAR_19XX = _fill(rf"{_NN}{_SEP}{_NN}{_SEP}(69|[7-9][0-9])")
_SERIAL = rf"^{_PAD}([0-9]{{3,6}}){_PAD}\z"


def excel_serial_date(c: str) -> str:
    """Excel day number of three to six digits as a date, inside the year window."""
    days = (
        f"CASE WHEN {matches(c, _SERIAL)} "
        f"THEN CAST(regexp_extract({c}, r'{_SERIAL}', 1) AS int) END"
    )
    return (
        f"CASE WHEN {days} BETWEEN {FIRST_SERIAL} AND {LAST_SERIAL} "
        f"THEN date_add(DATE'{EXCEL_DAY_ZERO}', {days}) END"
    )


def parse_mixed_dates(c: str, as_date: bool = False) -> str:
    """TIMESTAMP_NTZ of a mixed-format date cell (its day if `as_date`), null when it is not a date.

    A usual cell costs a match and a cast, an empty one nothing; the rarer forms are tried only
    when that gave nothing. The forms exclude each other, so their order is free.
    """
    dashed = f"replace(replace({c}, '/', '-'), '.', '-')"
    month = f"substring_index(substring_index({dashed}, '-', 2), '-', -1)"
    turned = f"concat(substr({c}, -4), '-', {month}, '-', substring_index({dashed}, '-', 1))"

    def read(pattern: str, text: str) -> str:
        return f"try_cast(regexp_replace({c}, r'{pattern}', '{text}') AS timestamp_ntz)"

    parsed = (
        f"coalesce({read(_LONG_YEAR, _LONG_YEAR_TEXT)}, {read(_YEAR_20XX, '20$3-$2-$1')}, "
        f"{read(_YEAR_19XX, '19$3-$2-$1')}, CAST({excel_serial_date(c)} AS timestamp_ntz))"
    )
    parsed = (
        f"CASE WHEN {c} = '' THEN NULL WHEN {matches(c, _YEAR_FIRST)} THEN try_cast({dashed} AS timestamp_ntz) "
        f"WHEN {matches(c, _YEAR_LAST)} THEN try_cast({turned} AS timestamp_ntz) ELSE {parsed} END"
    )
    return f"to_date({parsed})" if as_date else parsed


def is_date_token(c: str) -> str:
    """Cell holds something that was meant as a date (not null, not a null token)."""
    tokens = ", ".join(literal(t) for t in DATE_NULL_TOKENS)
    return f"({c} IS NOT NULL AND {strip(c)} NOT IN ({tokens}))"


def day_text(c: str) -> str:
    return f"date_format({c}, 'yyyy-MM-dd')"


def second_text(c: str) -> str:
    return f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"


def error_date(parsed: str) -> str:
    """ISO day of a parsed date, or the marker for rows that have none."""
    return f"coalesce({day_text(parsed)}, '{INVALID_DATE}')"
