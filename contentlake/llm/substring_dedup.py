"""Remove word windows that occur earlier in the corpus, by super-k-mer partitioning.

A window is `window` consecutive words. Its minimiser is the leftmost smallest hash among
its `gram`-word sequences; equal windows have equal minimisers at equal places. Consecutive
windows that share one minimiser occurrence travel as one packed string to the bucket of
that minimiser, about three words for each word of the text instead of `window`.

Common word pairs would draw a share of the whole corpus into one bucket. So windows are counted
by the first bits of their minimiser first, and those bits with more than `bucket_limit` windows and
`HOT` times the share that the smallest hashes get by chance are only taken where a window holds no
others: its windows spread over their second choices. Such bits are a few thousand at most, and
equal windows still choose alike.

A bucket arrives sorted by string and position. Equal strings are adjacent: all but the
first are repeats as a whole. Only if a bucket holds several different strings are their
windows compared one by one, byte for byte. A bucket that still has more than
`bucket_limit` windows is not held in memory: they are dealt again, each by its own hash, and sorted.
Equal strings within a task are combined before the shuffle, so that a passage in a third
of all documents arrives once per task.

Defined cases: a null, empty or short text has no window and keeps all its words; windows
are judged on the input; rows that share an id are told apart by their text, the smaller
hash being the earlier; equal rows of one id are one document and get the same result; null
ids come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import staged, text_bytes

WINDOW = 20
GRAM = 2
BUCKET_LIMIT = 200_000
HOT = 4
_CHUNK = 1 << 20  # words looked at together
_PLACE_BITS = 24
_BUCKET_BITS = 32  # of a minimiser; two that share them only share a bucket
_HOT_BITS = 19  # of a minimiser, the first of which marks the last choice
_LAST = np.uint64(1 << 63)  # sorts a word sequence behind all others
_COUNT_BITS = 20  # a place is a start and, in its low bits, the number of windows
_PACKED = "mini long, id {id}, row long, place long, text binary"
_NAMES = ["mini", "id", "row", "place", "text"]
_FOUND = "id {id}, row long, start long, stop long, text binary"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def super_kmers(words: list[bytes], breaks: np.ndarray, window: int, gram: int, hot: np.ndarray | None = None):
    """(minimiser, start, windows) arrays over concatenated documents.

    breaks: the end of each document among `words`; no window crosses one.
    hot: sorted first bits of the minimisers that are chosen last.
    """
    n = len(words)
    if n < window:
        return (np.empty(0, np.int64),) * 3
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))[ids]
    mixed = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        mixed = (mixed ^ base[j : j + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    mixed >>= np.uint64(1)
    # A word said twice is the last choice: in runs of one word every window would have another minimiser.
    for j in range(1, gram):
        again = ids[j : j + len(mixed)] == ids[j - 1 : j - 1 + len(mixed)]
        mixed[again] |= _LAST
    if hot is not None and len(hot):
        bits = (mixed >> np.uint64(64 - _HOT_BITS)).astype(np.int64)
        found = np.minimum(np.searchsorted(hot, bits), len(hot) - 1)
        mixed[hot[found] == bits] |= _LAST
    place = np.arange(len(mixed), dtype=np.uint64)
    key = (mixed >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | place
    least = _sliding_min(key, window - gram + 1)  # one per window, leftmost among equals
    starts = np.arange(len(least))
    whole = starts + window <= breaks[np.searchsorted(breaks, starts, "right")]
    chosen = least[whole]
    starts = starts[whole]
    if not len(starts):
        return (np.empty(0, np.int64),) * 3
    first = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)])
    return (
        (chosen[first] >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64),
        starts[first],
        np.diff(np.append(first, len(starts))),
    )


def _copies(texts: list[bytes], order: tuple[list, list]) -> list[int]:
    """Rows of the batch whose whole text stands in an earlier row of it."""
    first: dict[bytes, tuple] = {}
    at = [_position(order, i, 0) for i in range(len(texts))]
    for text, here in zip(texts, at):
        first[text] = min(here, first.get(text, here))
    return [i for i, text in enumerate(texts) if first[text] < at[i]]


def _documents(texts: list[bytes], skip: set[int], window: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Chunks of words with (row in batch, first word's place in the document, words) pieces.

    A document longer than a chunk comes in pieces that share window - 1 words.
    """
    words: list[bytes] = []
    parts: list[tuple[int, int, int]] = []
    for i, data in enumerate(texts):
        own = [] if i in skip else data.split()
        if len(own) < window:
            continue
        for at in range(0, len(own) - window + 1, _CHUNK):
            piece = own[at : at + _CHUNK + window - 1] if len(own) > _CHUNK else own
            words += piece
            parts.append((i, at, len(piece)))
            if len(words) >= _CHUNK:
                yield words, parts
                words, parts = [], []
    if words:
        yield words, parts


def _count(window: int, gram: int):
    """Windows per first bits of a minimiser, summed by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = (batch.column(0).to_pylist(), batch.column(1).to_pylist())
            texts = batch.column(2).to_pylist()
            for words, parts in _documents(texts, set(_copies(texts, order)), window):
                mini, _, windows = super_kmers(words, np.cumsum([n for _, _, n in parts]), window, gram)
                each, of = np.unique(mini >> (_BUCKET_BITS - _HOT_BITS), return_inverse=True)
                n = np.bincount(of, windows, len(each)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(n)], ["bits", "n"])

    return run


def hot_minimisers(rows: DataFrame, window: int, gram: int, limit: int, times: float = HOT) -> np.ndarray:
    """First bits of minimisers of over `limit` windows and over `times` the share that the smallest get
    by chance, sorted."""
    share = times * (window - gram + 1) / (1 << _HOT_BITS - 1)
    counted = rows.mapInArrow(_count(window, gram), "bits long, n long").groupBy("bits").agg(F.sum("n").alias("n"))
    counted = staged(counted, "minimisers")
    total = counted.agg(F.sum("n")).first()[0] or 0
    large = counted.where((F.col("n") > limit) & (F.col("n") > total * share)).select("bits")
    return np.sort(np.array([r[0] for r in large.collect()], np.int64))  # 1 / share at most


def _pack(window: int, gram: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), batch.column(1)
            order = (ids.to_pylist(), rows.to_pylist())
            texts = batch.column(2).to_pylist()
            copies = _copies(texts, order)
            most = (1 << _COUNT_BITS) - 1
            whole = [
                (i, at << _COUNT_BITS | min(most, n - at))
                for i in copies
                for n in [len(texts[i].split()) - window + 1]
                for at in range(0, n, most)
            ]
            if whole:
                take = pa.array([i for i, _ in whole])
                places = pa.array([p for _, p in whole])
                yield pa.RecordBatch.from_arrays(
                    [places, ids.take(take), rows.take(take), places, pa.nulls(len(whole), pa.binary())], _NAMES
                )
            for words, parts in _documents(texts, set(copies), window):
                of, at, size = (np.array(x, np.int64) for x in zip(*parts))
                ends = np.cumsum(size)
                mini, start, windows = super_kmers(words, ends, window, gram, hot)
                if not len(mini):
                    continue
                part = np.searchsorted(ends, start, "right")
                own_start = start - (ends - size)[part] + at[part]
                lens = np.fromiter(map(len, words), np.int64, len(words))
                stop = np.cumsum(lens + 1) - 1
                buf = b" ".join(words)
                a, b = (stop - lens)[start], stop[start + windows + window - 2]
                text = [buf[x:y] for x, y in zip(a.tolist(), b.tolist())]
                row_of = of[part]
                _combine(text, row_of, own_start, order)
                take = pa.array(row_of)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(mini),
                        ids.take(take),
                        rows.take(take),
                        pa.array(own_start << _COUNT_BITS | windows),
                        pa.array(text, pa.binary()),
                    ],
                    _NAMES,
                )

    return run


def _position(order: tuple[list, list], row: int, start: int) -> tuple:
    x = order[0][row]
    return (x is not None, x if x is not None else 0, order[1][row], start)


def _combine(text: list, row_of: np.ndarray, start: np.ndarray, order: tuple[list, list]) -> None:
    """Blank every string of which this chunk holds an earlier equal one: it is a repeat."""
    first: dict[bytes, int] = {}
    rows, starts = row_of.tolist(), start.tolist()
    for i, s in enumerate(text):
        j = first.setdefault(s, i)
        if j == i:
            continue
        mine, other = _position(order, rows[i], starts[i]), _position(order, rows[j], starts[j])
        if other < mine:
            text[i] = None
        elif mine < other:
            text[j] = None
            first[s] = i
        # Equal positions are equal rows of one id: both stay, neither is earlier.


def _match(window: int, bucket_limit: int):
    """Packed strings sorted by (mini, text, id, row, place) to repeats, or to single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        id_type = pa.null()

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[]] * 5
            out.clear()
            kinds = (id_type, pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], ["id", "row", "start", "stop", "text"]
            )

        mini = None
        strings: list[tuple] = []  # the bucket's different strings, each at its first place
        held = 0
        dealt = False  # this bucket is too large, its windows go on one by one
        last, last_at = None, None

        def windows_of(entry):
            text, doc, row, start = entry
            words = text.split(b" ")
            for k in range(len(words) - window + 1):
                yield b" ".join(words[k : k + window]), doc, row, start + k

        def close() -> None:
            nonlocal held
            if len(strings) > 1 and not dealt:
                first: dict[bytes, tuple] = {}
                for entry in strings:
                    for w, doc, row, at in windows_of(entry):
                        here = (doc is not None, doc, row, at)
                        there = first.get(w)
                        if there is None:
                            first[w] = here
                        elif _less(there, here):
                            out.append((doc, row, at, at + window, None))
                        elif here != there:
                            out.append((*there[1:], there[3] + window, None))
                            first[w] = here
            strings.clear()
            held = 0

        for batch in batches:
            id_type = batch.column(1).type
            key = batch.column(0).to_numpy()
            cols = [c.to_pylist() for c in batch.columns[1:]]
            for k, doc, row, place, text in zip(key.tolist(), *cols):
                start, n = place >> _COUNT_BITS, place & ((1 << _COUNT_BITS) - 1)
                if text is None:  # combined before the shuffle
                    out.append((doc, row, start, start + n + window - 1, None))
                    continue
                if k != mini:
                    close()
                    mini, dealt, last = k, False, None
                if text == last:
                    if (doc, row, start) != last_at:
                        out.append((doc, row, start, start + n + window - 1, None))
                    continue
                last, last_at = text, (doc, row, start)
                entry = (text, doc, row, start)
                if not dealt and held + n > bucket_limit:
                    dealt = True
                    for e in strings:
                        out.extend((d, r, a, a + window, w) for w, d, r, a in windows_of(e))
                    strings.clear()
                if dealt:
                    out.extend((d, r, a, a + window, w) for w, d, r, a in windows_of(entry))
                else:
                    strings.append(entry)
                    held += n
                if len(out) > 50_000:
                    yield flush()
            yield flush()
        close()
        if out:
            yield flush()

    return run


def _less(a: tuple, b: tuple) -> bool:
    return (a[0], a[1] if a[0] else 0, *a[2:]) < (b[0], b[1] if b[0] else 0, *b[2:])


def _repeats_of_single(rows: DataFrame) -> DataFrame:
    """Windows dealt one by one: all but the first of each are repeats."""
    first = rows.groupBy("text").agg(F.min(F.struct("id", "row", "start")).alias("first"))
    return rows.join(first, "text").where(
        ~F.struct("id", "row", "start").eqNullSafe(F.col("first"))
    ).select("id", "row", "start", "stop")


def repeated_spans(rows: DataFrame, window: int, gram: int, bucket_limit: int) -> DataFrame:
    """(id, row, start, stop): word spans of `rows` (id, row, data) that stand earlier too."""
    kind = rows.schema["id"].dataType.simpleString()
    hot = hot_minimisers(rows, window, gram, bucket_limit)
    packed = rows.mapInArrow(_pack(window, gram, hot), _PACKED.format(id=kind))
    # Strings without text are settled; they go anywhere, not to the bucket they came from.
    deal = F.when(F.col("text").isNull(), F.xxhash64("id", "place")).otherwise(F.col("mini"))
    dealt = packed.repartition(deal).sortWithinPartitions("mini", "text", "id", "row", "place")
    found = staged(dealt.mapInArrow(_match(window, bucket_limit), _FOUND.format(id=kind)), "repeats")
    spans = found.where("text is null").select("id", "row", "start", "stop")
    single = found.where("text is not null")
    return spans if single.isEmpty() else spans.union(_repeats_of_single(single))


def _cut(data: bytes, starts, stops) -> tuple[int, int, str]:
    words = data.split()
    n = len(words)
    if starts is None or not len(starts):
        return n, 0, hashlib.sha256(b" ".join(words)).hexdigest()
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.asarray(starts, np.int64), 1)
    np.add.at(edge, np.asarray(stops, np.int64), -1)
    keep = np.cumsum(edge[:-1]) == 0
    return n, int(n - keep.sum()), hashlib.sha256(b" ".join(compress(words, keep.tolist()))).hexdigest()


def _row_key(docs: DataFrame, id_col: str, data: Column) -> Column:
    """Tells rows of one id apart; a constant where no id is repeated."""
    again = docs.groupBy(id_col).count().where("count > 1")
    return F.lit(0).cast("long") if again.isEmpty() else F.xxhash64(data)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    bucket_limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """(`id_col`, n_words, n_removed, kept_sha256) for every row of `docs`."""
    data = text_bytes(text_col)
    row = _row_key(docs, id_col, data)
    rows = docs.select(F.col(id_col).alias("id"), row.alias("row"), data.alias("data"))
    spans = repeated_spans(rows, window, gram, bucket_limit)
    # A document's spans are fewer than its words, which one row holds anyway.
    per_doc = spans.groupBy(F.col("id").alias("_id"), F.col("row").alias("_row")).agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )

    @F.pandas_udf("binary")
    def pressed(data: pd.Series) -> pd.Series:
        return data.map(zstandard.ZstdCompressor().compress)

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def cut(data: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.DataFrame:
        whole = data.map(zstandard.ZstdDecompressor().decompress)
        return pd.DataFrame(
            [_cut(*x) for x in zip(whole, starts, stops)], columns=["n_words", "n_removed", "kept_sha256"]
        )

    rows = rows.withColumn("data", pressed("data"))  # whole texts are shuffled to their spans
    joined = rows.join(
        per_doc, rows["id"].eqNullSafe(per_doc["_id"]) & (rows["row"] == per_doc["_row"]), "left"
    )
    out = joined.select("id", cut("data", F.col("spans.start"), F.col("spans.stop")).alias("c"))
    return out.select(F.col("id").alias(id_col), "c.*")
