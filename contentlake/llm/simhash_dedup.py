"""Near-duplicate groups by 64-bit SimHash fingerprints.

Fingerprints within `radius` bits are linked. With `blocks` bit blocks at least
blocks - radius of them agree between linked fingerprints, so every choice of that many
blocks is a bucket key and each link meets in some bucket. Buckets are verified in vector
form and hand on a spanning forest only, never all pairs of a group. A bucket with more
than `bucket_limit` distinct fingerprints is not compared at all: its members are linked
exactly through the points within radius/2 of them, a linear expansion that Spark spreads.

Defined cases: a null or wordless text has fingerprint zero; fewer words than a shingle
count as one shingle; equal texts share a fingerprint and travel once; repeated rows and
null ids stay, a null id never names a component that has another id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import numbered, staged, text_bytes
from contentlake.llm.components import components

SEED = 42
BITS = 64
_ROWS = 1 << 14


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _ROWS):
        bits = np.unpackbits(hashes[at : at + _ROWS].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        # Sums of 255 bits fit a byte, which numpy adds many at a time.
        total += bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += bits[whole:].sum(axis=0, dtype=np.uint8)
    return total


def fingerprint(data: bytes, shingle: int) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included."""
    words = data.lower().split()
    n = len(words)
    if not n:
        return 0
    buf = b" ".join(words)
    if n <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(buf, SEED)], dtype=np.uint64)
    else:
        lens = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lens + 1) - 1
        starts = (ends - lens)[: n - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(buf[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())),
            np.uint64,
            n - shingle + 1,
        )
    bits = 2 * _ones(hashes) > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def of(data: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in data], dtype="int64")

    return of(text)


def block_masks(blocks: int, radius: int) -> list[int]:
    """One mask per choice of blocks - radius blocks, as signed 64-bit numbers."""
    if blocks <= radius:
        raise ValueError("blocks must exceed radius")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    each = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [_signed(sum(c)) for c in combinations(each, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _forest(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links inside runs of equal keys."""
    n = len(keys)
    label = np.arange(n)
    last = np.append(np.flatnonzero(keys[1:] != keys[:-1]), n - 1)
    end = last[np.searchsorted(last, label)] + 1
    at, step = label.copy(), 1
    while True:
        at = at[end[at] > at + step]
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= radius]
        a, b = near, near + step
        while len(a):
            ra, rb = label[a], label[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                break
            np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(nxt := label[label], label):
                label = nxt
        step += 1
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _bucket_links(radius: int, bucket_limit: int):
    """Batches sorted by (key, fp) to edges (a, b); b is null for members of too large a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b=None):
            a = pa.array(a.view(np.int64))
            b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
            return pa.RecordBatch.from_arrays([a, b], ["a", "b"])

        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        large = None  # key of a bucket that has passed the limit
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            if large is not None:
                of_large = keys == large
                if of_large.any():
                    yield out(fps[of_large])
                    keys, fps = keys[~of_large], fps[~of_large]
                if not len(keys):
                    continue
                large = None
            open_from = int(np.searchsorted(keys, keys[-1])) if np.all(keys[1:] >= keys[:-1]) else 0
            if open_from:
                yield from _closed(keys[:open_from], fps[:open_from], radius, bucket_limit, out)
            keys, fps = keys[open_from:], fps[open_from:]
            if len(keys) > bucket_limit:
                large = keys[-1]
                yield out(fps)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from _closed(keys, fps, radius, bucket_limit, out)

    return run


def _closed(keys, fps, radius, bucket_limit, out):
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.append(edges, len(keys)))
    size_of = np.repeat(sizes, sizes)
    over = size_of > bucket_limit
    if over.any():
        yield out(fps[over])
    pick = (size_of > 1) & ~over
    if pick.any():
        a, b = _forest(keys[pick], fps[pick], radius)
        if len(a):
            yield out(a, b)


def _ball(radius: int) -> list[int]:
    return [_signed(sum(1 << i for i in c)) for k in range(radius + 1) for c in combinations(range(BITS), k)]


def _midpoint_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links among `fps` (fp) whatever their number.

    For an even radius two fingerprints are within it if and only if the balls of half of it
    share a point. For an odd one the balls have (radius - 1) / 2 and one of the two
    fingerprints moves a bit further; both are stated as balls whose points meet.
    """
    near, far = _ball(radius // 2), _ball(radius - radius // 2)

    def points(ball: list[int], side: int) -> DataFrame:
        masks = F.array(*[F.lit(m) for m in ball]) if len(ball) < 100 else F.from_json(F.lit(str(ball)), "array<bigint>")
        return fps.select("fp", F.explode(masks).alias("m"), F.lit(side).alias("side")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("point"), "side"
        )

    if radius % 2 == 0:
        met = points(near, 0).groupBy("point").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
        every = points(near, 0).join(met.where("least <> most"), "point")
        return every.where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()
    inner = points(near, 0).groupBy("point").agg(F.min("fp").alias("b"))
    # Members of one small ball are linked as well: their distance is at most radius - 1.
    return points(far, 1).join(inner, "point").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct().union(
        points(near, 0).join(inner, "point").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    )


def link_fingerprints(fps: DataFrame, radius: int, blocks: int, bucket_limit: int) -> DataFrame:
    """Edges (a, b) whose components are those of all links among distinct `fps` (fp)."""
    masks = block_masks(blocks, radius)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    buckets = fps.select(F.explode(keys).alias("key"), "fp").repartition("key").sortWithinPartitions("key", "fp")
    found = staged(buckets.mapInArrow(_bucket_links(radius, bucket_limit), "a long, b long"), "links")
    large = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    edges = found.where("b is not null")
    if not large.isEmpty():
        edges = edges.union(_midpoint_links(staged(large, "large"), radius))
    return edges


def _rooted(
    rows: DataFrame, shingle: int, radius: int, blocks: int, bucket_limit: int
) -> tuple[DataFrame, DataFrame]:
    """(id, fp) of every row of `rows` (id, text), and (fp, first, root) of every fingerprint: its
    smallest id and its component."""
    marked = staged(rows.select("id", fingerprint_column(text_bytes("text"), shingle).alias("fp")), "fingerprints")
    fps = marked.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(link_fingerprints(fps.select("fp"), radius, blocks, bucket_limit))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    return marked, rooted


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
    blocks: int = 7,
    bucket_limit: int = 20_000,
) -> DataFrame:
    """(`id_col`, fingerprint, component_id) for every row of `docs`.

    component_id is the smallest id reachable over links, the row's own included.
    """
    marked, rooted = _rooted(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), shingle, radius, blocks, bucket_limit)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
    blocks: int = 7,
    bucket_limit: int = 20_000,
) -> DataFrame:
    """The first row of each group of `docs`, columns as they were.

    The first is that of the smallest id, null ids last; rows are told apart by number, so of
    equal rows, repeated ids and null ids one stays as of any group.
    """
    rows, row_col = numbered(docs)
    me = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("of"), F.col(row_col).alias("row"))
    _, rooted = _rooted(rows.select(me.alias("id"), F.col(text_col).alias("text")), shingle, radius, blocks, bucket_limit)
    first = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.row")
    # A row per group grows with the input: shuffled at every size, never broadcast.
    return rows.join(first.hint("merge"), rows[row_col] == first["row"], "left_semi").select(*docs.columns)
