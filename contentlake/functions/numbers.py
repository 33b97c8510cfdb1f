"""Localised numbers and percentages.

Casts sit behind a match: a cast that fails costs a Java exception, a match does not.
"""

from __future__ import annotations

from contentlake.functions.text import WS_CLASS, literal, matches, strip

MONEY = "decimal(38,9)"

# What a numeric cell may hold next to digits and the decimal comma.
_NOISE = rf"[.Rp{WS_CLASS}#-]"
_DIGIT_OR_NOISE = rf"[0-9.Rp{WS_CLASS}#-]"

# An acceptable numeric cell: an "empty" token, or allowed characters with at
# least one digit and at most one decimal comma (before or after the first digit).
NUMERIC_CELL = (
    rf"^(?:[{WS_CLASS}]*(?:-|(?i:nan|none|n/a))?[{WS_CLASS}]*"
    rf"|{_NOISE}*(?:,{_NOISE}*[0-9]{_DIGIT_OR_NOISE}*"
    rf"|[0-9]{_DIGIT_OR_NOISE}*(?:,{_DIGIT_OR_NOISE}*)?))\z"
)

# Usual cells, read without Unicode classes: each pattern is part of the one it stands for.
_USUAL_NUMBER = r"^[0-9.Rp -]*[0-9](?:,[0-9]+)?\z"
_USUAL_PERCENT = r"^[0-9.,%-]*\z"
_USUAL_FLOAT = r"^[0-9]+(?:\.[0-9]+)?\z"

# An acceptable percent cell: an "empty" token or allowed characters only.
PERCENT_CELL = rf"^(?:[{WS_CLASS}]*(?i:nan|none|n/a)[{WS_CLASS}]*|[0-9.,%{WS_CLASS}#-]*)\z"

# At least one digit and at most one comma, among whatever else.
_ONE_NUMBER = r"^[^0-9,]*(?:,[^0-9,]*[0-9][^,]*|[0-9][^,]*(?:,[^,]*)?)\z"
_INTEGER = rf"^[{WS_CLASS}]*[+-]?[0-9]+[{WS_CLASS}]*\z"
_DECIMAL = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_NUMBER = rf"^[{WS_CLASS}]*[+-]?{_DECIMAL}[{WS_CLASS}]*\z"
_FLOAT = rf"^[{WS_CLASS}]*[+-]?(?:{_DECIMAL}|(?i:inf|infinity|nan))[{WS_CLASS}]*\z"


def is_numeric_corrupt(c: str) -> str:
    """Forbidden characters, no readable number, or one whose whole part no bigint holds."""
    whole = f"substring_index(regexp_replace({c}, '[^0-9,]', ''), ',', 1)"
    # A cell of up to 18 characters has no more digits than a bigint holds: nearly all stop here. The branch keeps
    # them from it; behind an AND Spark takes `whole`, as it occurs twice, out of every cell first.
    too_large = (
        f"CASE WHEN length({c}) > 18 THEN length({whole}) > 18 AND try_cast({whole} AS bigint) IS NULL ELSE false END"
    )
    acceptable = f"({matches(c, _USUAL_NUMBER)} OR {matches(c, NUMERIC_CELL)})"
    return f"coalesce(NOT {acceptable} OR {too_large}, false)"


def is_percent_corrupt(c: str) -> str:
    return f"coalesce(NOT ({matches(c, _USUAL_PERCENT)} OR {matches(c, PERCENT_CELL)}), false)"


def _without(c: str, gone: str, comma: str = "") -> str:
    """`c` without the characters `gone` and with a point for the decimal `comma`: a search for each, no pattern."""
    for ch in gone:
        c = f"replace({c}, {literal(ch)}, '')"
    return f"replace({c}, '{comma}', '.')" if comma else c


def clean_number(c: str, default: int = 0) -> str:
    """Localised text to decimal(38,9); what cannot be read becomes `default`.

    Digits and the decimal comma count, every other character goes.
    """
    text = f"translate(regexp_replace({c}, '[^0-9,]', ''), ',', '.')"
    return (
        f"coalesce(CASE WHEN {matches(c, _USUAL_NUMBER)} THEN try_cast({_without(c, '.Rp -', ',')} AS {MONEY}) "
        f"WHEN {matches(c, _ONE_NUMBER)} THEN try_cast({text} AS {MONEY}) END, "
        f"CAST({default} AS {MONEY}))"
    )


def safe_long(c: str) -> str:
    """Text to bigint or null; '12.5' is null, not rounded."""
    return f"CASE WHEN {matches(c, _INTEGER)} THEN try_cast({strip(c)} AS bigint) END"


def safe_money(c: str) -> str:
    """Text to decimal(38,9) or null."""
    return f"CASE WHEN {matches(c, _NUMBER)} THEN try_cast({strip(c)} AS {MONEY}) END"


def safe_double(c: str) -> str:
    """Text to double or null; Java's '12d' suffix form is refused."""
    return f"CASE WHEN {matches(c, _FLOAT)} THEN try_cast({strip(c)} AS double) END"


def percent_to_fraction(c: str, decimal_comma: bool = False) -> str:
    """'12.3%' to 0.123.

    The class removes '%', a backslash and the letter 's', exactly as in the SQL
    this must agree with. A decimal comma gives null unless `decimal_comma`.
    """
    t = _without(c, "%\\s", "," if decimal_comma else "")
    usual = f"WHEN {matches(t, _USUAL_FLOAT)} THEN try_cast({t} AS double)"
    return f"CASE {usual} ELSE {safe_double(t)} END / 100D"


def round_half_even(c: str) -> str:
    """Nearest whole number, ties to even, null to 0; one that no bigint holds is null."""
    return f"CASE WHEN {c} IS NULL THEN 0L ELSE try_cast(bround({c}, 0) AS bigint) END"


def plain_number(c: str) -> str:
    """Decimal(38,9) text without trailing zeros: 12.000000000 -> 12, 1.500000000 -> 1.5.

    Spark's own text is taken where it has no exponent in any session. The rest is put together from
    whole numbers: the text of a decimal depends on the session (zero may read 0E-9).
    """
    d = f"try_cast({c} AS {MONEY})"
    billionths = f"CAST((abs({d}) % 1BD) * 1000000000BD AS bigint)"
    places = f"TRIM(TRAILING '0' FROM lpad(CAST({billionths} AS string), 9, '0'))"
    short = f"TRIM(TRAILING '.' FROM TRIM(TRAILING '0' FROM CAST({d} AS string)))"
    return (
        f"CASE WHEN {d} = 0BD THEN '0' WHEN abs({d}) >= 0.001BD THEN {short} "
        f"ELSE concat(if({d} < 0, '-', ''), CAST(floor(abs({d})) AS string), "
        f"if({billionths} = 0, '', concat('.', {places}))) END"
    )
