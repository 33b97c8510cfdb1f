"""Language of web pages by Bayesian fusion of four kinds of evidence.

* text: log-likelihood of the visible text's byte trigrams, counted over every labelled
  document, tempered so that a long text does not drown all else;
* markup: the language the page declares;
* address: the suffix of its host name;
* host: a prior smoothed from host to domain to the whole corpus.

What a declaration, a suffix or a host says about a language is not assumed but counted:
grouped sums of the text-only posteriors over all pages. A page's own posterior is taken
out of its host's and domain's sums, so that it does not vote twice.

Defined cases: a null or tagless page without text has a flat likelihood; a null address
has the empty host and suffix; a page without a declaration has the empty one, which is evidence
like any other; rows with equal ids are judged each; ties fall to the first language by
name; without a labelled document the result has no rows' languages (null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import staged

BUCKETS = 1 << 15
TEXT_WEIGHT = 8  # trigrams' worth of evidence at most
KAPPA = 5.0  # pages' worth of the wider prior
ALPHA = 1.0  # smoothing of declarations and suffixes
MAX_LANGUAGES = 400


def _trigrams(data: bytes) -> np.ndarray:
    raw = np.frombuffer(b" " + b" ".join(data.lower().split()) + b" ", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    key = raw[:-2] * np.uint32(65536) + raw[1:-1] * np.uint32(256) + raw[2:]
    return ((key * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def count_trigrams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all labelled documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, data in zip(pdf["lang"], pdf["data"]):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += np.bincount(_trigrams(data), minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("data"))
    return rows.mapInPandas(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class TextModel:
    """Log-probabilities of trigram buckets per language."""

    def __init__(self, rows: pd.DataFrame):
        self.langs = sorted(rows["lang"].unique())
        if len(self.langs) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        n = np.full((len(self.langs), BUCKETS), 0.5)
        at = {x: i for i, x in enumerate(self.langs)}
        n[rows["lang"].map(at).to_numpy(int), rows["bucket"].to_numpy(int)] += rows["n"].to_numpy(float)
        self.log_p = np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32)

    def log_likelihood(self, data: bytes, weight: float = TEXT_WEIGHT) -> np.ndarray:
        grams = _trigrams(data)
        if not len(grams):
            return np.zeros(len(self.langs))
        counts = np.bincount(grams, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        total = self.log_p[:, used].astype(float) @ counts[used]
        return total * min(1.0, weight / len(grams))


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|nav|footer|head)\b.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&[#\w]+;", " ")


def evidence(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, host, domain, suffix, declared, text) of every page."""
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    declared = F.regexp_extract(F.coalesce(html_col, F.lit("")), r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,8})""", 1)
    return pages.select(
        F.col(id_col).alias("id"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
        F.lower(declared).alias("declared"),
        visible_text(F.coalesce(html_col, F.lit(""))).cast("binary").alias("data"),
    )


def text_posteriors(rows: DataFrame, model: TextModel, weight: float) -> DataFrame:
    """log-likelihoods `ll` and the posterior `q` under a flat prior."""

    @F.pandas_udf("ll array<double>, q array<double>")
    def of(data: pd.Series) -> pd.DataFrame:
        ll = [model.log_likelihood(x, weight) for x in data]
        q = [np.exp(x - x.max()) for x in ll]
        return pd.DataFrame({"ll": ll, "q": [x / x.sum() for x in q]})

    return rows.select("id", "host", "domain", "suffix", "declared", of("data").alias("t")).select("*", "t.ll", "t.q").drop("t")


def _sums(q: DataFrame, by: str, name: str) -> DataFrame:
    """(`by`, `name`): the sum of the posteriors of a group, an array by language."""
    each = q.select(by, F.posexplode("q").alias("at", "x")).groupBy(by, "at").agg(F.sum("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "x")))  # an entry per language
    return each.groupBy(by).agg(F.transform(ordered, lambda e: e["x"]).alias(name))


def _total(values: str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def identify(
    pages: DataFrame,
    labelled: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    text_col: str = "text",
    lang_col: str = "lang",
    weight: float = TEXT_WEIGHT,
    kappa: float = KAPPA,
    alpha: float = ALPHA,
) -> DataFrame:
    """(`id_col`, lang, confidence, text_lang, declared, suffix, host, posterior) per page."""
    counts = count_trigrams(labelled, text_col, lang_col).toPandas()  # languages x BUCKETS rows at most
    rows = evidence(pages, id_col, url_col, html_col)
    if counts.empty:
        none = F.lit(None)
        return rows.select(
            F.col("id").alias(id_col), none.cast("string").alias("lang"), none.cast("double").alias("confidence"),
            none.cast("string").alias("text_lang"), "declared", "suffix", "host",
            none.cast("map<string,double>").alias("posterior"),
        )
    model = TextModel(counts)
    langs = model.langs
    k = len(langs)
    q = staged(text_posteriors(rows, model, weight), "text_posteriors")
    each = q.select(F.posexplode("q").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()  # by language
    sums = {r["at"]: r["x"] for r in each}
    total = [sums.get(i, 0.0) for i in range(k)]
    kinds = q.agg(F.count("*").alias("n"), F.count_distinct("suffix").alias("s"), F.count_distinct("declared").alias("m")).first()
    world = F.array(*[F.lit((x + 1.0) / (kinds["n"] + k)) for x in total])
    joined = q
    for by, name in (("host", "h"), ("domain", "d"), ("suffix", "s"), ("declared", "m")):
        joined = joined.join(_sums(q, by, name), by)

    def others(name: str) -> Column:
        """Pages' worth of the group's evidence without the page itself."""
        return F.greatest(_total(name) - 1.0, F.lit(0.0))

    def score(i: Column) -> Column:
        def less_own(name: str) -> Column:
            return F.greatest(F.get(name, i) - F.get("q", i), F.lit(0.0))

        domain = (less_own("d") + kappa * F.get("world", i)) / (F.col("nd") + kappa)
        host = (less_own("h") + kappa * domain) / (F.col("nh") + kappa)
        suffix = (less_own("s") + alpha) / (F.get("total", i) + alpha * max(kinds["s"], 1))
        declared = (less_own("m") + alpha) / (F.get("total", i) + alpha * max(kinds["m"], 1))
        return F.get("ll", i) + F.ln(host) + F.ln(suffix) + F.ln(declared)

    sized = joined.select(
        "*", others("h").alias("nh"), others("d").alias("nd"), world.alias("world"),
        F.array(*[F.lit(x) for x in total]).alias("total"), F.sequence(F.lit(0), F.lit(k - 1)).alias("at"),
    )
    scored = sized.select("id", "declared", "suffix", "host", "q", F.transform("at", score).alias("z"))
    top = F.array_max("z")
    weights = F.transform("z", lambda x: F.exp(x - top))
    names = F.array(*[F.lit(x) for x in langs])
    fused = scored.select("*", weights.alias("w")).withColumn("all", _total("w")).withColumn("p", F.transform("w", lambda x: x / F.col("all")))
    return fused.select(
        F.col("id").alias(id_col),
        F.element_at(names, F.array_position("p", F.array_max("p")).cast("int")).alias("lang"),
        F.array_max("p").alias("confidence"),
        F.element_at(names, F.array_position("q", F.array_max("q")).cast("int")).alias("text_lang"),
        "declared",
        "suffix",
        "host",
        F.map_from_arrays(names, "p").alias("posterior"),
    )
