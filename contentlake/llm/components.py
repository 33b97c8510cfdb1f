"""Connected components of an edge table by alternating large-star and small-star steps.

The published two-step scheme: every node hands its larger neighbours to its smallest one,
then every node hands its smaller neighbours and itself to the smallest. Each step is one
aggregation and one join; nothing is gathered per node, so a star with a million leaves is
a million rows that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge (a, b) has a > b here."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: same orderable type), root the smallest node.

    Self-loops, nulls and repeated or reversed edges are allowed and add nothing. A root
    itself is not listed. No edges give no rows.
    """
    e = staged(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = _digest(e)
    while before[0]:
        e = staged(_small_star(_large_star(e).distinct()).distinct(), "stars")
        now = _digest(e)
        if now == before:
            break
        before = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
