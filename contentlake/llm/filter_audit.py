"""How filters interact: what each removes at each step of every order they can be applied in.

A row's failed filters are a bit mask, so a part of the corpus is 2^n weights, counted by
Spark. Which step removes a mask under an order is a min-plus product: the mask matrix has
0 where a filter is failed and infinity elsewhere, the position matrix holds the inverse
permutation of each order, and the minimum over filters of their sum is the step that
removes the mask (infinity: kept). Weights scattered to these steps are the counts removed;
what fails a filter and is not removed by it was removed before, so it is redundant.

The filters of `audit`, on whole texts (words: runs of anything but ASCII white space):

* A: under 100 words,
* B: distinct words under 80 % of the words, case kept,
* C: capitals A-Z over 10 % of the code points,
* D: holds one of the symbols #$%&*|
* E: the text of a row with a smaller id, anywhere in the table.

Texts are told apart by SHA-256. Equal texts are counted by id, label and part before
any two of them meet, and a hot text goes on as one row per part and label.

Defined cases: a null text is the empty one, a null part the part ''; a null id is larger than
any other and not smaller than another null; rows with equal ids and texts stand or fall together;
rows without a label are neither good nor toxic, of several labels of an id any counts; an
empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contentlake.llm.common import text_bytes

FILTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
SYMBOLS = b"#$%&*|"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_INNER = bytes(range(0x80, 0xC0))  # bytes that do not start a code point
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_PARTS_AT_ONCE = 64


def text_mask(data: bytes) -> int:
    """Bits of the failed filters A to D."""
    words = data.split()  # bytes are split at space and \t to \r
    n = len(words)
    chars = len(data.translate(None, _INNER))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    return (
        (n < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
        | (100 * capitals > CAPITAL_PERCENT * chars) << 2
        | (len(data.translate(None, SYMBOLS)) < len(data)) << 3
    )


@F.pandas_udf(StructType().add("mask", "integer").add("digest", "binary"))
def _marks(data: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"mask": [text_mask(x) for x in data], "digest": [hashlib.sha256(x).digest() for x in data]})


def removal_steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of n filters, and the step (from 1, infinity: none) that removes each mask under each."""
    orders = np.array(list(permutations(range(n))))
    positions = np.argsort(orders, axis=1) + 1.0
    masks = np.arange(1 << n)[:, None] >> np.arange(n) & 1
    costs = np.where(masks == 1, 0.0, np.inf)
    return orders, (costs[:, None, :] + positions[None, :, :]).min(axis=2)


def interactions(weights: np.ndarray, orders: np.ndarray, steps: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per order and step, from the rows, good rows and toxic rows of each mask (masks x 3)."""
    n_orders, n = orders.shape
    lost = np.zeros((n_orders, n, 3), np.int64)
    every = np.arange(n_orders)
    for mask in np.flatnonzero(weights[:, 0]):
        hit = np.isfinite(steps[mask])
        np.add.at(lost, (every[hit], steps[mask][hit].astype(int) - 1), weights[mask])
    removed = lost[:, :, 0]
    bits = np.arange(len(weights))[:, None] >> np.arange(n) & 1
    fails = (bits * weights[:, :1]).sum(axis=0)
    by_filter = np.zeros(n, np.int64)
    np.add.at(by_filter, orders, removed)
    return {
        "kept": weights[:, 0].sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": fails[orders] - removed,
        "unique_fails": weights[1 << np.arange(n), 0][orders],
        "good_lost": lost[:, :, 1],
        "toxic_lost": lost[:, :, 2],
        "shapley": by_filter[orders],
    }


def _with_copies(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): `marked` rows (id, part, digest, mask) counted, with bit E set for copies."""
    counted = marked.groupBy("id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    # Null ids have no label; their texts differ here, so they are spread by them.
    spread = F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0))
    named = counted.withColumn("spread", spread).join(labels.withColumn("spread", F.lit(0).cast("long")), ["id", "spread"], "left")
    keys = ["digest", "part", "mask", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]]
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n")).alias("first")
    # Labels belong to ids: the rows of one id and text in one part are one row of `counted`.
    groups = named.groupBy(*keys).agg(first, F.sum("n").alias("n"))
    least = F.min(F.struct("first.none", "first.id")).over(Window.partitionBy("digest"))
    placed = groups.withColumn("least", least)
    alone = (
        F.when(F.col("least.none"), F.col("n"))
        .when(F.col("first.id").eqNullSafe(F.col("least.id")), F.col("first.n"))
        .otherwise(0)
    )
    copy_bit = 1 << FILTERS.index("E")
    both = F.array(
        F.struct(F.col("mask").alias("mask"), alone.alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(copy_bit)).alias("mask"), (F.col("n") - alone).alias("n")),
    )
    return placed.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.*").where("n > 0")


def audit_masks(weighted: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order and step, from counted masks (part, mask, good, toxic, n).

    Works for any filters whose masks are given; the orders are all permutations of them. A
    part is at most 2^len(filters) rows when it meets in one task.
    """
    sums = [F.sum(F.when(flag, F.col("n")).otherwise(0)).alias(name)
            for name, flag in (("good", F.col("good")), ("toxic", F.col("toxic")))]
    of_mask = weighted.groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums)
    of_part = of_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("of"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = len(filters)
        orders, steps = removal_steps(n)
        names = ["".join(filters[i] for i in o) for o in orders]
        head = {"filter_order": np.repeat(names, n), "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))}
        for pdf in batches:
            held = []
            for part, of in zip(pdf["part"], pdf["of"]):
                weights = np.zeros((1 << n, 3), np.int64)
                for m in of:
                    weights[m["mask"]] = m["n"], m["good"], m["toxic"]
                counts = interactions(weights, orders, steps)
                held.append(pd.DataFrame({"part": part, **head, **{c: x.ravel() for c, x in counts.items()}}))
                if len(held) == _PARTS_AT_ONCE:
                    yield pd.concat(held)
                    held = []
            if held:
                yield pd.concat(held)

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return of_part.mapInPandas(run, f"part string, filter_order string, step int, {counts}")


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    label_id_col: str = "doc_id",
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    marked = docs.select(F.col(id_col).alias("id"), part.alias("part"), _marks(text_bytes(text_col)).alias("m"))
    flags = labels.where(F.col(label_id_col).isNotNull()).groupBy(F.col(label_id_col).alias("id")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    return audit_masks(_with_copies(marked.select("id", "part", "m.digest", "m.mask"), flags))


ORACLE_SQL = r"""WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
marked AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN min(x.doc_id) OVER (PARTITION BY t) < x.doc_id THEN 'E' ELSE '' END AS failed
  FROM texts x LEFT JOIN flags f ON f.doc_id = x.doc_id),
masks AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM marked GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT m.*, o, (SELECT min(strpos(o, y)) FROM (SELECT unnest(string_split(failed, '')) AS y) u WHERE y <> '') AS s
  FROM masks m, orders),
rows AS (SELECT part, o, k, substr(o, k, 1) AS f, sum(n) AS total, coalesce(sum(n) FILTER (s <= k), 0) AS gone,
    coalesce(sum(n) FILTER (s = k), 0) AS removed, coalesce(sum(n) FILTER (s < k AND contains(failed, substr(o, k, 1))), 0) AS redundant,
    coalesce(sum(n) FILTER (failed = substr(o, k, 1)), 0) AS unique_fails,
    coalesce(sum(good) FILTER (s = k), 0) AS good_lost, coalesce(sum(toxic) FILTER (s = k), 0) AS toxic_lost
  FROM steps, (SELECT unnest([1, 2, 3, 4, 5]) AS k) ks GROUP BY part, o, k)
SELECT part, o AS filter_order, CAST(k AS INTEGER) AS step, CAST(total - gone AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM rows"""
