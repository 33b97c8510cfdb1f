"""Quality rules from a public vocabulary's view of a text.

Base rules: too few words, or too many words in repeated 8-word windows. The method's own:
characters per token (fertility), share of byte-fallback tokens and token entropy, each held
against a band of the text's language (its script where no language is given). Bands come
from the whole corpus: the distances of the quartiles from the median over all documents
that pass the base rules, taken `spread` times and never narrower than `MARGIN`. The ends of a
group's band are drawn towards those of the document's script as if `prior_docs` documents of
that script were in the group, so a small group leans on its script, a large one on itself, and
no number of documents switches the rule. A script has a band however few its documents are;
only texts without letters, or of a script not listed here, lean on the band of all documents.

Defined cases: a null, empty or wordless text has zeros, fails the base and is not kept;
rows with equal ids are judged each; an empty table gives an empty result. A text is held
whole in one task, words are encoded one by one, so its length only costs time.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import of_worker, staged, text_bytes, with_key, without

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
BLOCK = 128  # tokens that an entropy is taken over
SPREAD = 10.0
PRIOR_DOCS = 50  # weight of a script's band in the band of a group, in documents
DECIMALS = 3  # of the values that quartiles are taken over
MAX_BROADCAST = 10_000  # bands, about 100 bytes each
#: Least distance of a band's ends from the median.
MARGIN = {"chars_per_token": 0.25, "byte_share": 0.1, "entropy": 0.05}
_MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, byte_share double, chars_per_token double, entropy double, script string"
_CACHED_WORDS = 1 << 19
_CACHED_BYTES = 64

#: First code points of the blocks told apart here, and their scripts.
_BLOCKS = (
    (0x0000, "other"), (0x0041, "latin"), (0x005B, "other"), (0x0061, "latin"), (0x007B, "other"), (0x00C0, "latin"),
    (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
)
_STARTS = np.array([b for b, _ in _BLOCKS])
_NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())


def script_of(data: bytes) -> str:
    """The script most letters belong to; "other" if there are none."""
    if data.isascii():
        return "latin" if data.translate(None, _NO_LETTERS) else "other"
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    counts: dict[str, int] = {}
    for i, n in zip(*np.unique(np.searchsorted(_STARTS, points, "right") - 1, return_counts=True)):
        counts[_BLOCKS[i][1]] = counts.get(_BLOCKS[i][1], 0) + int(n)
    counts.pop("other", None)
    return max(counts, key=lambda s: (counts[s], s), default="other")


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows whose sequence occurs twice or more in `ids`."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = np.zeros(n, np.uint64)
    for i in range(window):
        key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ (ids[i : i + n].astype(np.uint64) + np.uint64(1))
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    maybe = np.sort(order[np.r_[same, False] | np.r_[False, same]])
    rows = np.stack([ids[maybe + i] for i in range(window)], axis=1)  # equal keys prove nothing yet
    _, back, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = maybe[times[back.ravel()] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def token_entropy(tokens: np.ndarray, block: int = BLOCK) -> float:
    """Mean entropy of the text's blocks (the text itself if shorter), as a share of the most it
    could be. Blocks of one length make texts comparable; the last one ends at the text's end and
    overlaps the one before it, so that every token is in a block."""
    n = len(tokens)
    if n < 2:
        return 0.0
    size = min(n, block)
    rest = tokens[n - size :] if n % size else tokens[:0]
    used = np.concatenate([tokens[: n // size * size], rest]).astype(np.int64)
    key = np.arange(len(used)) // size * (1 << 32) + used
    _, counts = np.unique(key, return_counts=True)
    return 1.0 - float((counts * np.log2(counts)).sum()) / len(used) / math.log2(size)


class WordPieces:
    """Pieces of single words by a public vocabulary with byte fallback."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.is_byte = np.array([self.model.IsByte(i) for i in range(self.model.vocab_size())])
        self.known: dict[bytes, np.ndarray] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        new = set(words).difference(self.known)
        if len(self.known) > _CACHED_WORDS:
            self.known.clear()
            new = set(words)
        fresh = list(new)
        pieces = self.model.encode([w.decode("utf-8", "replace") for w in fresh], num_threads=1) if fresh else []
        learnt = {w: np.array(p, np.uint16).tobytes() for w, p in zip(fresh, pieces)}
        self.known.update(learnt)
        found = np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.uint16)
        for w in fresh:
            if len(w) > _CACHED_BYTES:
                del self.known[w]
        return found


def measure(data: bytes, pieces: WordPieces) -> tuple:
    """The measures of one text, as listed in `_MEASURES`."""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\v\f\r")]
    packed = data.translate(None, b" \t\n\v\f\r")
    chars = len(packed) if packed.isascii() else len(packed.decode("utf-8", "replace"))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    tokens = pieces.ids(words)
    n = len(tokens)
    return (
        len(words),
        chars,
        sum(map(data.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        n,
        float(pieces.is_byte[tokens].sum()) / n if n else 0.0,
        chars / n if n else 0.0,
        token_entropy(tokens),
        script_of(data),
    )


def measured(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, lang_col: str | None) -> DataFrame:
    """(id, group, measures) of every row."""
    names = [x.split()[0] for x in _MEASURES.split(", ")]

    @F.pandas_udf(_MEASURES)
    def of(data: pd.Series) -> pd.DataFrame:
        pieces = of_worker(WordPieces, vocabulary)
        return pd.DataFrame([measure(x, pieces) for x in data], columns=names)

    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), lang.alias("lang"), of(text_bytes(text_col)).alias("m"))
    return rows.select("id", F.coalesce("lang", F.concat(F.lit("script "), "m.script")).alias("group"), "m.*")


def _band(name: str, spread: float):
    # Exact counts of rounded values: the state is bounded (a piece has a bounded length, the other
    # measures end at 1) and the quartiles don't depend on how the rows lie in partitions.
    p = F.percentile(F.round(name, DECIMALS), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    low = p[1] - F.greatest(F.lit(spread) * (p[1] - p[0]), F.lit(MARGIN[name]))
    high = p[1] + F.greatest(F.lit(spread) * (p[2] - p[1]), F.lit(MARGIN[name]))
    return F.struct(low.alias("low"), high.alias("high")).alias(f"{name}_band")


def bands(passed: DataFrame, spread: float = SPREAD, key: str = "group") -> tuple[DataFrame, DataFrame]:
    """Bands and number of documents per `key`, and the one band of all."""
    each = [_band(name, spread) for name in MARGIN]
    return passed.groupBy(key).agg(F.count("*").alias("docs"), *each), passed.agg(*each)


def judge(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    spread: float = SPREAD,
    prior_docs: int = PRIOR_DOCS,
) -> DataFrame:
    """(`id_col`, group, measures, base_failed, kept) for every row of `docs`."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    rows = staged(measured(docs, vocabulary, id_col, text_col, lang_col).withColumn("base_failed", failed), "measured")
    passed = rows.where("not base_failed")
    of_group, of_all = bands(passed, spread)
    whole = of_all.first()  # one row
    of_script = bands(passed.where(F.col("script") != "other"), spread, "script")[0].drop("docs")
    of_group, of_script = staged(of_group, "bands"), staged(of_script, "script_bands")
    of_script = of_script.withColumnsRenamed({f"{name}_band": f"{name}_script" for name in MARGIN})
    # A row per language or script; should a column hold more kinds than that, Spark joins it as it sees fit.
    if of_group.count() <= MAX_BROADCAST:
        of_group = F.broadcast(of_group)
    judged = rows.join(of_group, "group", "left").join(F.broadcast(of_script), "script", "left")
    inside = F.lit(True)
    own = F.col("docs") / (F.col("docs") + F.lit(prior_docs))
    for name in MARGIN:
        low, high = (whole[f"{name}_band"] or (None, None)) if whole else (None, None)
        ends = [
            own * F.col(f"{name}_band.{end}") + (1 - own) * F.coalesce(f"{name}_script.{end}", F.lit(of).cast("double"))
            for end, of in (("low", low), ("high", high))
        ]
        inside &= F.col(name).between(*ends)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(inside, F.lit(True)))
    return judged.select(F.col("id").alias(id_col), *[c for c in rows.columns if c != "id"], kept.alias("kept"))


def keep_good(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", **how
) -> DataFrame:
    """`docs` without the rejected rows, columns as they were. A verdict holds for the rows of its id, text and language."""
    keyed, key = with_key(docs, id_col, text_col, *[lang_col] * bool(lang_col))
    return without(keyed, judge(keyed, vocabulary, key, text_col, lang_col, **how).where("not kept"), key)
