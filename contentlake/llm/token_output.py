"""Token ids as Arrow files of equal-length sequences.

Documents are dealt by ranges of their id; each task encodes its range in order and writes
one pair of Arrow files to the shared folder:

* `<shard>.seq.arrow`: record batches of two fixed-size-list columns, `ids` (uint16, or
  uint32 for larger vocabularies) and `mask` (bool, false only for the padding that ends a
  shard). A row is one training sequence; any batch can be mapped without a copy.
* `<shard>.doc.arrow`: doc_id, start and n_tokens of each document within the shard.

Files are named by shard and task attempt, and only those named in the manifest, which Spark
commits, count: a repeated task cannot leave half a shard behind. The manifest has a row
per shard, and a document's place in the corpus is its place in the shard plus all shards before.

Defined cases: a null or empty text is the end id alone; null ids come first; repeated ids
keep all their rows, ordered by text; no documents, no files and no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.llm.common import new_path, of_worker, pieces, staged, text_bytes

END_ID = 2
SEQ_LEN = 2048
_BATCH = 256  # sequences per record batch
_CACHED_WORDS = 3 << 18
_CACHED_BYTES = 64  # longer words are encoded each time
_SYMBOLS = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])  # printable ASCII but letters and digits
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")  # of Latin-1, which lower-case one for one
_WORD_END = "</w>"


def parted(data: bytes) -> bytes:
    """`data` with a space between a lower-case letter and an ASCII symbol that follows it."""
    x = np.frombuffer(data, np.uint8)
    after = (x[:-1] >= 97) & (x[:-1] <= 122) & _SYMBOLS[x[1:]]
    return np.insert(x, np.flatnonzero(after) + 1, 32).tobytes() if after.any() else data


class WordEncoder:
    """Ids of whole texts by a tokenizer whose pieces never hold white space.

    The vocabulary's own splitter drops white space and never joins across it, so a text's
    ids are those of its words in order, and a word met again needs no second encoding. It
    lowers case and always parts a letter from a symbol after it, so doing both
    beforehand changes no id and leaves fewer different words. Texts that may hold the
    string of a special token, whose case matters, are left as they are.

    A word of letters alone is one piece and ends with the one of its tokens that ends a piece,
    so such words are encoded as one text and told apart by these.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        words = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith(_WORD_END)]] = True
        self.known: dict[bytes, bytes] = {}

    def _encode(self, texts: list[bytes]) -> list[list[int]]:
        whole = [x.decode("utf-8", "replace") for x in texts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        plain = [w for w in words if _LETTERS.fullmatch(w)]
        ids = np.array(self._encode([b" ".join(plain)])[0], dtype=self.dtype)
        stops = (np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize
        if len(stops) == len(plain):
            data, starts = ids.tobytes(), [0, *stops[:-1].tolist()]
            found = {w: data[a:b] for w, a, b in zip(plain, starts, stops.tolist())}
        else:  # a vocabulary without such tokens
            found = {}
        rest = [w for w in words if w not in found]
        return found | {w: np.array(x, dtype=self.dtype).tobytes() for w, x in zip(rest, self._encode(rest))}

    def encode(self, data: bytes) -> Iterator[bytes]:
        plain = b"<|" not in data
        for piece in pieces(data):
            words = (parted(piece.lower()) if plain else piece).split()
            found = list(map(self.known.get, words))
            new = {w for w, x in zip(words, found) if x is None}
            if new:
                learnt = self._learn(new)
                found = [learnt[w] if x is None else x for w, x in zip(words, found)]
                if len(self.known) > _CACHED_WORDS:  # the usual words are met first
                    self.known = dict(islice(self.known.items(), _CACHED_WORDS // 2))
                self.known.update((w, x) for w, x in learnt.items() if len(w) <= _CACHED_BYTES)
            yield b"".join(found)


def encoder(vocabulary: str) -> WordEncoder:
    """One per worker process, so that what it has learnt outlives a task."""
    return of_worker(WordEncoder, vocabulary)


def _lists(values: np.ndarray, seq_len: int, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values, kind), seq_len)


def _seq_schema(kind: pa.DataType, seq_len: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])


def _writer(root: str, vocabulary: str, end_id: int, seq_len: int):
    """Batches of (doc_id, data) in order to one shard and its manifest row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, ipc

        task = TaskContext.get()
        name = f"{root}/shard-{task.partitionId():08d}-{task.taskAttemptId()}"
        words = encoder(vocabulary)
        kind = pa.from_numpy_dtype(words.dtype)
        end = np.array([end_id], words.dtype).tobytes()
        schema, whole = _seq_schema(kind, seq_len), seq_len * _BATCH * words.dtype.itemsize
        sinks, held, n_docs, n_tokens = None, bytearray(), 0, 0

        def flush(size: int) -> None:
            ids = np.frombuffer(bytes(held[:size]), words.dtype)
            del held[:size]
            gap = -len(ids) % seq_len
            mask = np.ones(len(ids) + gap, bool)
            mask[len(ids) :] = False
            ids = np.concatenate([ids, np.zeros(gap, words.dtype)])
            seqs.write_batch(
                pa.record_batch([_lists(ids, seq_len, kind), _lists(mask, seq_len, pa.bool_())], schema=schema)
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            if sinks is None:
                store, path = fs.FileSystem.from_uri(name)
                store.create_dir(path.rpartition("/")[0], recursive=True)
                sinks = [store.open_output_stream(f"{path}.{x}.arrow") for x in ("seq", "doc")]
                seqs = ipc.new_file(sinks[0], schema)
                doc_schema = pa.schema([("doc_id", batch.column(0).type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                docs = ipc.new_file(sinks[1], doc_schema)
            starts, counts = [], []
            for data in batch.column(1):
                first = n_tokens
                for ids in words.encode(data.as_py()):
                    held += ids
                    n_tokens += len(ids) // words.dtype.itemsize
                    while len(held) >= whole:
                        flush(whole)
                held += end
                n_tokens += 1
                starts.append(first), counts.append(n_tokens - first)
            docs.write_batch(pa.record_batch([batch.column(0), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=doc_schema))
            n_docs += batch.num_rows
        if sinks is None:
            return
        while held:
            flush(min(whole, len(held)))
        for x in (seqs, docs, *sinks):
            x.close()
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([task.partitionId()], pa.int32()), "path": [name], "n_docs": [n_docs], "n_tokens": [n_tokens]}
        )

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    seq_len: int = SEQ_LEN,
) -> DataFrame:
    """Write the files under `path` and return the manifest: shard, path, n_docs, n_tokens, base."""
    dealt = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("data"))
    ordered = dealt.repartitionByRange("id").sortWithinPartitions("id", "data")
    made = ordered.mapInArrow(
        _writer(path, vocabulary, end_id, seq_len), "shard int, path string, n_docs long, n_tokens long"
    )
    # A row per shard: the driver only adds up where each shard starts.
    rows, base, out = sorted(staged(made, "manifest").collect()), 0, []
    for r in rows:
        out.append((*r, base))
        base += r["n_tokens"]
    spark = docs.sparkSession
    return spark.createDataFrame(out, "shard int, path string, n_docs long, n_tokens long, base long")


def _reader(seq_len: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, ipc

        def parts(seqs):
            for i in range(seqs.num_record_batches):
                b = seqs.get_batch(i)
                n = b.column(1).flatten().true_count if b.num_rows else 0
                yield b.column(0).flatten().to_numpy()[:n].astype("<u4", copy=False)

        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, at = fs.FileSystem.from_uri(path)
                with store.open_input_file(f"{at}.seq.arrow") as s, store.open_input_file(f"{at}.doc.arrow") as d:
                    source, held = parts(ipc.open_file(s)), np.empty(0, "<u4")
                    index = ipc.open_file(d)
                    for i in range(index.num_record_batches):
                        b = index.get_batch(i)
                        sums = []
                        for n in b.column(2).to_pylist():
                            crc, left = 0, n
                            while left:
                                if not len(held):
                                    held = next(source)
                                crc = zlib.crc32(held[:left].tobytes(), crc)
                                held, left = held[left:], left - min(left, len(held))
                            sums.append(crc)
                        starts = pa.array(np.asarray(b.column(1)) + base)
                        yield pa.record_batch(
                            [b.column(0), starts, b.column(2), pa.array(sums, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return run


def read_documents(manifest: DataFrame, id_type: str = "long", seq_len: int = SEQ_LEN) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    shards = max(1, manifest.count())
    return (
        manifest.select("path", "base")
        .repartition(shards)
        .mapInArrow(_reader(seq_len), f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
    )


def sequence(path: str, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of one sequence of a shard on a local or mounted disk, mapped, not copied."""
    with pa.memory_map(f"{path.removeprefix('file://')}.seq.arrow") as m:
        f = pa.ipc.open_file(m)
        for i in range(f.num_record_batches):
            b = f.get_batch(i)
            if row < b.num_rows:
                mask = b.column(1)[row].values.to_numpy(zero_copy_only=False)
                return b.column(0)[row].values.to_numpy(), mask
            row -= b.num_rows
    raise IndexError(row)


def corpus_tokens(docs: DataFrame, vocabulary: str, **how) -> DataFrame:
    """Write the corpus to the shared folder and read every document back."""
    spark: SparkSession = docs.sparkSession
    id_col = how.get("id_col", "doc_id")
    manifest = write_tokens(docs, new_path(spark, "tokens"), vocabulary, **how)
    return read_documents(manifest, docs.schema[id_col].dataType.simpleString(), how.get("seq_len", SEQ_LEN))
