"""Spelling variants: words one edit apart, joined by asymmetric q-chunks.

1. Words. Runs of letters are counted over all texts; a rule given by a hash of document and
   run drops a letter here and there, which makes the variants to be found. Counts are
   combined within a task before they are shuffled.
2. Chunks and grams. The shorter word of a pair (of equals the one first in order) gives two
   disjoint chunks, its first and its last q letters, q half its length. The other gives its
   positional grams of that length. One edit leaves at least one chunk whole and shifts it by
   one place at most, so the pair meets on an equal chunk. Which shift an edit can have
   caused is known for either chunk, so grams at other places are not written.
3. Pairs that meet are verified in the join itself, so only true pairs come out: half of the other
   letters must be equal as well, and the edit distance 1.
4. A word's form is its most frequent near word, if that is `ratio` times as frequent. As the
   frequency rises along forms, they have no cycle; roots are found by doubling the way.

Defined cases: a null text has no words; a null id counts as the empty text in the hash; rows
with equal ids and repeated rows count each; words found in fewer than `min_count` places or
shorter than `min_length` are left out, also as near words; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import staged, text_bytes

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
DROP_EVERY = 31
_HELD = 1 << 18
#: U+00C0 to U+00FF are the two bytes C3 80 to C3 BF, and no other code point holds the byte C3.
_RUNS = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
_LETTERS = bytes(c if 97 <= c <= 122 else 32 for c in range(256))


def runs(data: bytes) -> list[bytes]:
    """Maximal runs of letters, A-Z lowered."""
    lower = data.lower()  # of bytes: ASCII letters only
    return lower.translate(_LETTERS).split() if data.isascii() else _RUNS.findall(lower)


def said(doc_id: str, data: bytes, min_length: int, drop_every: int) -> Iterator[tuple[str, int]]:
    """(word, times) of one text, after the rule that drops a letter."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    for run, times in Counter(runs(data)).items():
        if len(run) < min_length:
            continue
        word, h = run.decode(), zlib.crc32(run, seed)
        if h % drop_every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        if len(word) >= min_length:
            yield word, times


def vocabulary(
    docs: DataFrame, id_col: str, text_col: str, min_length: int, min_count: int, drop_every: int
) -> DataFrame:
    """(word, n) of the words said `min_count` times or more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for pdf in batches:
            for doc_id, data in zip(pdf["id"], pdf["data"]):
                for word, times in said(doc_id, data, min_length, drop_every):
                    held[word] += times
                if len(held) > _HELD:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_bytes(text_col).alias("data"))
    counted = rows.mapInPandas(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _meet(shorter: int) -> list[Column]:
    """(key, front, back) for the first and the last chunk of a word `shorter` letters less long than `word`.

    key: which chunk, the length of its word, and the letters that stand where an edit can have left them:
    the first chunk is only left whole by an edit behind it, so it stands where it stood; the last one
    by an edit before it, so it is shifted by the difference of the lengths. A gram at another place within
    one of the chunk's would find no pair that these do not.
    front, back: the two parts of the letters outside the chunk; one edit leaves one of them as it was, too.
    """
    length = F.length("word") - shorter
    q = F.floor(length / 2).cast("int")
    half = F.floor((length - q) / 2).cast("int")

    def letters(at: Column, n: Column) -> Column:
        return F.substring(F.col("word"), at + 1, n)

    out = []
    for kind, chunk_at, rest_at in ((0, F.lit(0), q), (1, length - q + shorter, F.lit(0))):
        key = F.xxhash64(F.lit(kind), length, letters(chunk_at, q))
        front = F.xxhash64(letters(rest_at, half))
        back = F.xxhash64(letters(rest_at + half + shorter, length - q - half))
        out.append(F.struct(key.alias("key"), front.alias("front"), back.alias("back")))
    return out


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(a, a_n, b, b_n) of all pairs of `words` (word, n) with edit distance 1, each pair once.

    Words need `min_length` letters or more, at least 2.
    """
    fits = F.length("word") > min_length  # a word one letter shorter is long enough
    grams_at = F.array_compact(F.array(*_meet(0), *[F.when(fits, x) for x in _meet(1)]))
    chunks = words.select(F.explode(F.array(*_meet(0))).alias("c"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    grams = words.select(F.explode(grams_at).alias("g"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    chunks, grams = chunks.select("c.*", "a", "a_n"), grams.select("g.*", "b", "b_n")
    ordered = (F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    alike = (chunks["front"] == grams["front"]) | (chunks["back"] == grams["back"])
    met = chunks.join(grams, (chunks["key"] == grams["key"]) & alike & ordered & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word on the way along `forms` (word, form), which have no cycle."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        far = staged(far, "roots")
        now = far.select("word", "root")
        if far.where("moved").isEmpty():
            return now


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    drop_every: int = DROP_EVERY,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word."""
    words = staged(vocabulary(docs, id_col, text_col, min_length, min_count, drop_every), "words")
    pairs = staged(near_pairs(words, min_length), "pairs")
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("m")).union(
        pairs.select("b", "a", "a_n")
    )
    best = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("top"))
    m = -F.col("top.less")
    of_form = F.col("n_near").isNotNull() & (m >= ratio * F.col("n"))
    formed = staged(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(of_form, F.col("top.near")).alias("form"),
            F.when(of_form, m).alias("form_n"),
        ),
        "forms",
    )
    last = roots(formed.where("form is not null"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
