"""Remove multi-line chunks that stand earlier in the corpus.

Chunk boundaries depend on content only: a chunk ends after a line where a rolling hash over
the hashes of that line and the one before is divisible by `every`. Lines put in or
taken out elsewhere do not move them. Chunks of two lines or more whose hash occurs more than once
are then grouped by their bytes, and all but the first of each group are removed.

DataFrame functions only. A text is marked and cut into chunks by its own row's expressions.
Texts are shuffled whole once, to meet the places of their repeated hashes and later those to
remove; chunks are shuffled as hashes, and as texts only where the hash is repeated. The
aggregations combine before their shuffle, so a chunk in a third of all documents arrives
once per task.

Defined cases: a null text is one empty line and stays null; empty lines are lines;
single-line chunks are never removed; rows that share an id are told apart by their
text's hash and equal rows of one id get the same result; the first chunk is that of the
smallest (id, hash, place), null ids first; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import staged

EVERY = 3
FACTOR = 31
HEX_DIGITS = 12


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, HEX_DIGITS), 16, 10).cast("long")


def chunks(text: Column, every: int = EVERY) -> Column:
    """Array of chunks, each with an x before every line: "xfirst\\nxsecond".

    With that mark an empty line is not empty, so that a blank line can only be a boundary.
    """
    lines = F.split(text, "\n", -1)
    own = F.transform(lines, _line_hash)
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice(F.transform(lines, _line_hash), 1, F.greatest(F.size(lines) - 1, F.lit(0))))
    ends = F.zip_with(own, before, lambda a, b: (a + FACTOR * b) % every == 0)
    marked = F.zip_with(lines, ends, lambda x, end: F.concat(F.lit("x"), x, F.when(end, F.lit("\n")).otherwise(F.lit(""))))
    return F.split(F.regexp_replace(F.array_join(marked, "\n"), r"\n\z", ""), "\n\n", -1)


def _whole(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text).alias("row"))


def _with_places(whole: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """`whole` with the array `places` of its row. Every use shares one shuffle of the texts."""
    named = places.withColumnsRenamed({"id": "_id", "row": "_row"})
    same = whole["id"].eqNullSafe(named["_id"]) & (whole["row"] == named["_row"])
    return whole.join(named, same, how).drop("_id", "_row")


def _of_row(places: DataFrame) -> DataFrame:
    """(id, row, places), sorted: a row's places are fewer than its lines, which one row holds anyway."""
    return places.groupBy("id", "row").agg(F.sort_array(F.collect_set("place")).alias("places"))


def repeated_chunks(whole: DataFrame, every: int) -> DataFrame:
    """(id, row, places) of the rows that hold a multi-line chunk with an equal one before it."""
    cut = chunks(F.coalesce("text", F.lit("")), every)
    rows = whole.select("id", "row", F.posexplode(cut).alias("place", "chunk")).where(F.contains("chunk", F.lit("\n")))
    hashed = rows.select("id", "row", "place", F.xxhash64("chunk").alias("key"))
    keys = staged(hashed.groupBy("key").count().where("count > 1").select("key"), "chunk_keys")
    # Hashes find the places, and only the texts of those are compared.
    maybe = _with_places(whole, _of_row(hashed.join(keys, "key", "left_semi")), "inner").select(
        "id", "row", F.explode(F.transform("places", lambda i: F.struct(i.alias("place"), F.get(cut, i).alias("chunk")))).alias("c")
    )
    maybe = maybe.select("id", "row", "c.place", "c.chunk")
    place = F.struct("id", "row", "place")
    first = maybe.groupBy("chunk").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    return _of_row(maybe.join(first.select("chunk", "first"), "chunk").where(~place.eqNullSafe(F.col("first"))))


def _kept(parts: Column, gone: Column) -> Column:
    """`parts` without the places in the sorted array `gone`, in time linear in both."""
    shifted = F.concat(F.array(F.lit(-1)), gone)
    runs = F.zip_with(
        F.slice(shifted, 1, F.size(gone)), gone, lambda a, b: F.concat(F.array_repeat(F.lit(False), b - a - 1), F.array(F.lit(True)))
    )
    # zip_with pads the shorter array with null, which stands for the parts after the last removed one.
    paired = F.zip_with(parts, F.flatten(runs), lambda c, out: F.when(F.coalesce(out, F.lit(False)), F.lit(None)).otherwise(c))
    return F.filter(paired, lambda c: c.isNotNull())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY) -> DataFrame:
    """(`id_col`, text, n_lines, n_removed) for every row, text without the repeated chunks."""
    whole = _whole(docs, id_col, text_col)
    joined = _with_places(whole, repeated_chunks(whole, every), "left").withColumnRenamed("places", "gone")
    # An array of the kept chunks' lines, each still behind its mark.
    kept = F.array_join(_kept(chunks(F.col("text"), every), F.col("gone")), "\n")
    fresh = F.substring(F.regexp_replace(kept, "\nx", "\n"), 2, 2147483647)
    shown = joined.select(
        "id", F.col("text").alias("old"), F.when(F.col("gone").isNull(), F.col("text")).otherwise(fresh).alias("text"),
        F.col("gone").isNotNull().alias("cut"), (F.col("gone").isNotNull() & (kept == "")).alias("bare"),
    )
    lines = F.coalesce(F.regexp_count("old", F.lit("\n")), F.lit(0)) + 1
    left = F.when(F.col("bare"), F.lit(0)).otherwise(F.coalesce(F.regexp_count("text", F.lit("\n")), F.lit(0)) + 1)
    return shown.select(
        F.col("id").alias(id_col), "text", lines.cast("long").alias("n_lines"), (lines - left).cast("long").alias("n_removed")
    )


#: The same in DuckDB, over `documents`, with the digest columns of the query.
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
line AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, {HEX_DIGITS}))::BIGINT AS h FROM line),
rolled AS (
  SELECT *, (h + {FACTOR} * coalesce(lag(h) OVER w, 0)) % {EVERY} = 0 AS ends FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
),
placed AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM rolled
),
chunk AS (SELECT doc_id, c, count(*) AS n, string_agg('x' || line, chr(10) ORDER BY i) AS body FROM placed GROUP BY doc_id, c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, c) AS k FROM chunk),
gone AS (SELECT doc_id, c FROM ranked WHERE n > 1 AND k > 1),
kept AS (
  SELECT p.doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
  FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.c = g.c GROUP BY p.doc_id
)
SELECT d.doc_id, len(d.l)::BIGINT AS n_lines, (len(d.l) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
