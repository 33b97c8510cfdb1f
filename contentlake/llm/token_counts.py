"""Token counts of the parts of a document, by offsets.

A document is encoded once, whole. Its tokens are byte spans that tile the text; its
sections are character spans, turned into byte spans. The two are joined as intervals
(sorted ends, binary search), so a section costs two look-ups whatever it holds. A token
that crosses a section's edge is allocated by an explicit rule:

* `start`: to the sections that hold its first byte,
* `majority`: to the sections that hold over half of its bytes (an even split: those that
  hold its first byte),
* `share`: to every section it touches, by the part of its bytes that lies there.

Sections that tile a text share out exactly its tokens under `start` and `share`.

Defined cases: a null or empty text has one empty section by default, with no tokens; null
sections count as none; spans are cut to the text and empty ones have no tokens; overlapping
and nested sections are counted each on its own; rows with equal ids are counted each.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("start", "majority", "share")
_OUT = "{id}, section long, name string, start long, end long, n_inside long, n_crossing long, tokens double, doc_tokens long"


class ByteTokens:
    """A byte-level vocabulary: a text's token ends in bytes."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        return np.cumsum(self.lengths[self.encoding.encode_to_numpy(text)])


_LOADED: dict[tuple[str, str], ByteTokens] = {}


def line_spans(text: str) -> list[tuple[str, int, int]]:
    """Lines with the newline that ends them: they tile the text."""
    out, at = [], 0
    for line in text.split("\n"):
        end = min(at + len(line) + 1, len(text))
        out.append(("line", at, end))
        at = end
    return out


def byte_offsets(text: str, chars: np.ndarray) -> np.ndarray:
    """Byte position of character positions in the text's UTF-8 form."""
    chars = np.clip(chars, 0, len(text))
    if text.isascii():
        return chars
    data = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))[chars]


def attribute(ends: np.ndarray, a: np.ndarray, b: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per byte span [a, b): tokens wholly inside, tokens crossing an edge, tokens allocated."""
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    b = np.maximum(a, b)
    first_in = np.searchsorted(starts, a, "left")
    last_in = np.searchsorted(ends, b, "right")
    inside = np.maximum(last_in - first_in, 0)
    touch_from, touch_to = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
    touched = np.where(b > a, np.maximum(touch_to - touch_from, 0), 0)
    inside = np.where(b > a, inside, 0)
    if rule == "start":
        got = (np.searchsorted(starts, b, "left") - first_in).astype(float)
        return inside, touched - inside, np.where(b > a, np.maximum(got, 0), 0)
    got = inside.astype(float)
    # At most two tokens cross a span's edges: the first and the last one it touches.
    for side in (0, 1):
        at = np.where(side == 0, touch_from, touch_to - 1)
        real = (touched > 0) & ((side == 0) | (touch_to - 1 > touch_from))
        at = np.where(real, at, 0)
        if not len(ends):
            break
        s, e = starts[at], ends[at]
        held = np.minimum(e, b) - np.maximum(s, a)
        real &= (s < a) | (e > b)
        if rule == "share":
            part = held / np.maximum(e - s, 1)
        else:
            part = np.where(2 * held == e - s, s >= a, 2 * held > e - s)
        got += np.where(real, part, 0.0)
    return inside, touched - inside, got


def section_tokens(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections_col: str | None = None,
    rule: str = "start",
) -> DataFrame:
    """A row per section: `id_col`, section (its place), name, start, end, n_inside, n_crossing,
    tokens, doc_tokens.

    sections_col: array<struct<name: string, start: long, end: long>> in characters; by
    default the sections are the text's lines.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (ranks_path, pattern) not in _LOADED:
            _LOADED[ranks_path, pattern] = ByteTokens(ranks_path, pattern)
        tokens = _LOADED[ranks_path, pattern]
        for batch in batches:
            rows, cols, held = [], [[] for _ in range(8)], 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                if sections_col is None:
                    spans = line_spans(text)
                else:
                    spans = [(s["name"], s["start"] or 0, s["end"] or 0) for s in batch.column(2)[i].as_py() or [] if s]
                if not spans:
                    continue
                ends = tokens.ends(text)
                names, a, b = zip(*spans)
                at = np.clip(np.array([a, b], np.int64), 0, len(text))
                inside, crossing, got = attribute(ends, byte_offsets(text, at[0]), byte_offsets(text, at[1]), rule)
                n = len(spans)
                rows.append(np.full(n, i))
                for col, x in zip(cols, (np.arange(n), names, at[0], at[1], inside, crossing, got, np.full(n, len(ends)))):
                    col.append(x)
                held += n
                if held >= 50_000:
                    yield _batch(batch, rows, cols)
                    rows, cols, held = [], [[] for _ in range(8)], 0
            if held:
                yield _batch(batch, rows, cols)

    kept = [F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    if sections_col:
        kept.append(F.col(sections_col).alias("sections"))
    out = _OUT.format(id=f"id {docs.schema[id_col].dataType.simpleString()}")
    return docs.select(*kept).mapInArrow(run, out).withColumnRenamed("id", id_col)


def _batch(batch: pa.RecordBatch, rows: list, cols: list) -> pa.RecordBatch:
    ids = batch.column(0).take(pa.array(np.concatenate(rows)))
    names = pa.array([x for part in cols[1] for x in part], pa.string())
    number = [pa.array(np.concatenate(c).astype(np.float64 if k == 6 else np.int64)) for k, c in enumerate(cols) if k != 1]
    return pa.RecordBatch.from_arrays(
        [ids, number[0], names, *number[1:]],
        ["id", "section", "name", "start", "end", "n_inside", "n_crossing", "tokens", "doc_tokens"],
    )
