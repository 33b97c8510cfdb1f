"""Row hashes: lower-case hex SHA-256 over '||'-joined text."""

from __future__ import annotations

SEPARATOR = "||"


def row_hash(*parts: str) -> str:
    """Null parts are left out together with their separator."""
    return f"sha2(concat_ws('{SEPARATOR}', {', '.join(parts)}), 256)"
