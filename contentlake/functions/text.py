"""Text expressions shared by validation, hashing and the silver projections."""

from __future__ import annotations

# The characters Unicode treats as white space, which a plain
# Spark trim (U+0020 only) would leave in place.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as the inside of a regular-expression character class.
WS_CLASS = r"\t-\r\x1c-\x20\x85\p{Z}"

# Lower-cased cell texts that stand for "nothing here".
BLANK_TOKENS = ("", "-", "nan", "none", "nat")
EMPTY_TOKENS = ("", "nan", "none", "-", "n/a")
MANIFEST_EMPTY_TOKENS = ("", "nan", "none", "-", "n/a", "nat")

# Characters deleted from a column name.
NAME_NOISE = ".()%/-"

_PADDED = rf"^[{WS_CLASS}]|[{WS_CLASS}]\z"


def _padded_token(tokens: tuple[str, ...]) -> str:
    """Pattern of a cell that is one of `tokens` in any case, padded or not."""
    return rf"^[{WS_CLASS}]*(?i:{'|'.join(t for t in tokens if t)})?[{WS_CLASS}]*\z"


def q(name: str) -> str:
    """Column reference by exact name, even when the name holds dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str) -> str:
    """SQL string literal; control and non-ASCII characters as escapes."""
    plain = "".join(
        ch if " " <= ch < "\x7f" and ch not in "'\\" else f"\\u{ord(ch):04x}" for ch in value
    )
    return f"'{plain}'"


def matches(c: str, pattern: str) -> str:
    return f"({c} RLIKE r'{pattern}')"


def strip(c: str) -> str:
    """Trim every Unicode white-space character from both ends.

    Few cells have any, so one cheap match decides whether the trim runs at all.
    """
    return f"CASE WHEN {matches(c, _PADDED)} THEN btrim({c}, {literal(WHITESPACE)}) ELSE {c} END"


def upper_trim(c: str) -> str:
    return f"upper({strip(c)})"


def canon(c: str) -> str:
    """Canonical text for hashing: null becomes '', else stripped and upper-cased."""
    return f"coalesce({upper_trim(c)}, '')"


def or_empty(c: str) -> str:
    return f"coalesce({c}, '')"


def empty_to_null(c: str) -> str:
    return f"nullif({c}, '')"


def is_blank(c: str) -> str:
    """Cell is null or one of the blank tokens after strip."""
    return f"({c} IS NULL OR {matches(c, _padded_token(BLANK_TOKENS))})"


def is_non_empty(c: str) -> str:
    """Cell holds content. Unlike `is_blank`, 'n/a' is empty and 'nat' is content."""
    return f"({c} IS NOT NULL AND NOT {matches(c, _padded_token(EMPTY_TOKENS))})"


def has_id(c: str) -> str:
    """Id present: not the empty text after strip. A null id passes."""
    return f"({c} IS NULL OR NOT {matches(c, _padded_token(('',)))})"


def snake_case(name: str) -> str:
    """Column-name normalisation (schema work on the driver, no data involved)."""
    spaced = name.lower().strip().replace(" ", "_")
    return spaced.translate({ord(ch): None for ch in NAME_NOISE})
