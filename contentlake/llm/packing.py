"""Documents packed into as few fixed-length sequences as possible, by dominance and best fit.

Documents are encoded in Spark and cut at the capacity, so a piece is just a length of 1 to
`capacity` tokens, and pieces of one length are interchangeable. The instance to solve is
therefore the number of pieces of each length, `capacity` counts whatever the corpus holds:

1. Reduction. For a piece of each length, the longest first, the sets of pieces it can share a
   sequence with are looked at. A set that dominates all others (each alternative can be
   split into groups that no piece of the set is shorter than) is fixed for good,
   as some optimal packing holds it:
   * nothing else fits: the piece alone,
   * a piece fills the gap exactly,
   * at most one more fits: the longest,
   * at most two more fit: the longest and the longest beside it, if no pair has a longer second
     piece; or the longest alone, if no pair is longer than it in sum.
   It is fixed for as many pieces at once as there are, and the shrunk instance is looked at
   again until nothing more is fixed.
2. Best fit. The rest goes, longest first, each to the fullest sequence it fits into.

The plan is a list of entries (length, from which number on, sequence, per sequence, offset). A
sequence is named by its number, equal sequences by an interval of numbers, so an entry covers
any number of pieces; there are at most some 4 intervals per length, and a sequence has at most
sqrt(2 x capacity) different lengths, which bounds the plan whatever the input. Pieces
find their entry by their number among those of their length: they are numbered within their
task while they are encoded, and the tasks' counts are added up in order.

Defined cases: a null or empty text is the end id alone; rows with equal ids are separate
documents; nothing is packed twice or left out; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contentlake.llm.common import staged, text_bytes
from contentlake.llm.token_output import encoder

CAPACITY = 4096
END_ID = 1
_RANKS = 1 << 44  # more pieces of one length than that are not numbered


@dataclass
class Instance:
    """Pieces of each length that are still to be packed."""

    capacity: int
    counts: dict[int, int]
    lengths: list[int] = field(init=False)

    def __post_init__(self) -> None:
        self.counts = {n: c for n, c in self.counts.items() if c}
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.lengths.remove(length)

    def smallest(self, without: int, n: int) -> list[int]:
        """The n smallest pieces (fewer if there are no more) beside one of length `without`."""
        out: list[int] = []
        for x in self.lengths:
            out += [x] * min(n - len(out), self.counts[x] - (x == without))
            if len(out) == n:
                break
        return out

    def longest(self, limit: int, without: tuple[int, ...]) -> int | None:
        """The longest piece of up to `limit` tokens beside the pieces `without`."""
        for i in range(bisect_right(self.lengths, limit) - 1, -1, -1):
            x = self.lengths[i]
            if self.counts[x] > without.count(x):
                return x
        return None

    def second_of_pair(self, room: int, without: int) -> int:
        """The longest second piece of any pair that fits into `room`, 0 if none does."""
        for i in range(bisect_right(self.lengths, room // 2) - 1, -1, -1):
            y = self.lengths[i]
            have = self.counts[y] - (y == without)
            if have >= 2:
                return y
            if have:
                for x in self.lengths[i + 1 :]:
                    if x + y > room:
                        break
                    if self.counts[x] > (x == without):
                        return y
        return 0

    def longest_pair(self, room: int, without: int) -> int:
        """The largest sum of a pair that fits into `room`, 0 if none does."""
        best = 0
        for y in self.lengths[: bisect_right(self.lengths, room // 2)]:
            if self.counts[y] > (y == without):
                x = self.longest(room - y, (without, y))
                if x is not None:
                    best = max(best, x + y)
        return best


def dominating(of: Instance, length: int) -> tuple[int, ...] | None:
    """A set with a piece of `length` that dominates every other set with it, or None if none is proven to."""
    room = of.capacity - length
    small = of.smallest(length, 3)
    if not small or small[0] > room:
        return (length,)
    longest = of.longest(room, (length,))
    if longest == room or len(small) < 2 or small[0] + small[1] > room:
        return length, longest
    if len(small) == 3 and sum(small) <= room:
        return None
    beside = of.longest(room - longest, (length, longest))
    if beside is None:
        return (length, longest) if longest >= of.longest_pair(room, length) else None
    return (length, longest, beside) if beside >= of.second_of_pair(room, length) else None


def reduce_instance(of: Instance) -> list[tuple[tuple[int, ...], int]]:
    """Sets fixed for good and how often; what is left in `of` is the shrunk instance.

    What makes a set dominate stays true as pieces leave, so it is fixed until one of its lengths is used up.
    """
    fixed = []
    while True:
        before = len(fixed)
        for length in reversed(list(of.lengths)):
            while length in of.counts:
                found = dominating(of, length)
                if found is None:
                    break
                times = min(of.counts[x] // found.count(x) for x in set(found))
                for x in found:
                    of.take(x, times)
                fixed.append((found, times))
        if len(fixed) == before:
            return fixed


@dataclass
class Plan:
    """Entries (length, first number, sequence, per sequence, offset) and the number of sequences."""

    capacity: int
    entries: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    fixed: int = 0
    _used: dict[int, int] = field(default_factory=dict)

    def put(self, length: int, sequence: int, n: int, each: int, offset: int) -> None:
        """`each` pieces of a length at `offset` into each of `n` sequences."""
        first = self._used.get(length, 0)
        self.entries.append((length, first, sequence, each, offset))
        self._used[length] = first + n * each

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n


def best_fit(of: Instance, plan: Plan) -> None:
    """All pieces of `of`, longest first, each to the fullest open sequence it fits into."""
    # Sequences with the same free room, as intervals of their numbers: (first, how many).
    free: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def add(room: int, first: int, n: int) -> None:
        if room not in free:
            free[room] = []
            insort(rooms, room)
        free[room].append((first, n))

    def place(length: int, room: int, first: int, n: int, each: int) -> None:
        plan.put(length, first, n, each, plan.capacity - room)
        if room > each * length:
            add(room - each * length, first, n)

    for length in reversed(of.lengths):
        left = of.counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = plan.capacity // length
                if left >= each:
                    place(length, plan.capacity, plan.open(left // each), left // each, each)
                if left % each:
                    place(length, plan.capacity, plan.open(1), 1, left % each)
                break
            room = rooms[i]
            first, n = free[room].pop()
            if not free[room]:
                del free[room], rooms[i]
            # A sequence that has taken one is the fullest that fits the next, while any fits.
            each = min(room // length, left)
            whole = min(n, left // each)
            if n > whole:
                add(room, first + whole, n - whole)
            place(length, room, first, whole, each)
            left -= whole * each


def plan_for(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """A packing of `counts` (pieces per length of 1 to `capacity`)."""
    of, plan = Instance(capacity, counts), Plan(capacity)
    for found, times in reduce_instance(of):
        sequence, offset = plan.open(times), 0
        for x in sorted(set(found), reverse=True):
            plan.put(x, sequence, times, found.count(x), offset)
            offset += x * found.count(x)
    plan.fixed = plan.sequences
    best_fit(of, plan)
    return plan


def _encode(vocabulary: str, end_id: int, capacity: int, with_ids: bool):
    """(id, data) to pieces, numbered per length within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        part, size, numbers = TaskContext.get().partitionId(), words.dtype.itemsize, np.zeros(capacity + 1, np.int64)
        end, whole = np.array([end_id], words.dtype).tobytes(), capacity * words.dtype.itemsize
        for batch in batches:
            rows: list[int] = []
            out: list[tuple[int, int, int, int, int, bytes]] = []

            def cut(row: int, piece: int, data: bytes) -> None:
                ids = np.frombuffer(data, words.dtype).astype("<u4").tobytes()
                n = len(data) // size
                rows.append(row)
                out.append((piece, piece * capacity, n, zlib.crc32(ids), int(numbers[n]), ids if with_ids else b""))
                numbers[n] += 1

            for row, data in enumerate(batch.column(1)):
                held, piece = bytearray(), 0
                for ids in words.encode(data.as_py()):
                    held += ids
                    while len(held) > whole:
                        cut(row, piece, bytes(held[:whole]))
                        del held[:whole]
                        piece += 1
                held += end
                for at in range(0, len(held), whole):
                    cut(row, piece, bytes(held[at : at + whole]))
                    piece += 1
            if not rows:
                continue
            cols = list(zip(*out))
            arrays = [batch.column(0).take(pa.array(rows)), pa.array(cols[0], pa.int32())]
            arrays += [pa.array(c, pa.int64()) for c in cols[1:4]]
            arrays += [pa.array(np.full(len(rows), part, np.int32)), pa.array(cols[4], pa.int64())]
            arrays += [pa.array(cols[5], pa.binary())] * with_ids
            names = ["id", "piece", "start", "length", "ids_crc32", "part", "number", *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def _placed(plan: Plan):
    """Sequence and offset of the k-th piece of a length."""
    rows = np.array(sorted(plan.entries), np.int64).reshape(-1, 5)
    starts = rows[:, 0] * _RANKS + rows[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def of(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        n, k = length.to_numpy(), number.to_numpy()
        at = rows[np.searchsorted(starts, n * _RANKS + k, "right") - 1]
        k = k - at[:, 1]
        return pd.DataFrame({"sequence_id": at[:, 2] + k // at[:, 3], "offset": at[:, 4] + k % at[:, 3] * n})

    return of


def pack(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """(`id_col`, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row.

    with_ids: also the piece's `ids`, little-endian unsigned 32-bit, for `sequences`.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, part int, number long" + ", ids binary" * with_ids
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("data"))
    # The scan's own partitions: a task that is run again numbers its pieces as before.
    pieces = staged(rows.mapInArrow(_encode(vocabulary, end_id, capacity, with_ids), schema), "pieces")
    of_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(of_task.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "bases")
    counts = bases.groupBy("length").agg(F.sum("n").alias("n")).collect()  # `capacity` rows at most
    plan = plan_for({r["length"]: r["n"] for r in counts}, capacity)
    # A row of `bases` per task and length grows with the input: shuffled, not broadcast.
    numbered = pieces.join(bases.drop("n").hint("merge"), ["part", "length"])
    place = _placed(plan)(F.col("length"), F.col("base") + F.col("number"))
    ids = ["ids"] * with_ids
    return numbered.select("id", "piece", "start", "length", "ids_crc32", *ids, place.alias("p")).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", *ids, "p.sequence_id", "p.offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_tokens) from `pack` with ids: a sequence is `capacity` tokens at most."""
    each = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(each, F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))
