"""One row per key: the newest snapshot, or the first of equal rows.

Both are `row_number() = 1`. Spark turns that into a group limit ahead of the
shuffle, so a key that holds a third of the table still sends at most one row per
map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentlake.functions.text import upper_trim


def latest_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    # Led by a hash of the keys, the sort tells nearly all rows apart by one number: many keys begin alike.
    return _first(df, [F.xxhash64(*keys), *keys], order)


def _first(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _key_text(name: str) -> Column:
    return F.expr(upper_trim(f"coalesce({name}, '')"))


def _newest(*tie_breaks: str) -> list[Column]:
    return [F.desc("snapshot_ts"), F.desc("run_id"), *[F.desc(t) for t in tie_breaks]]


def latest_video(bronze: DataFrame, tie_breaks: tuple[str, ...] = ("row_hash_raw",)) -> DataFrame:
    keys = [
        F.expr(upper_trim("toko")),
        _key_text("id_kreator"),
        _key_text("id_video"),
        F.to_date("tanggal"),
    ]
    return latest_per_key(bronze, keys, _newest(*tie_breaks))


def latest_production(
    bronze: DataFrame, tie_breaks: tuple[str, ...] = ("row_hash_raw",)
) -> DataFrame:
    keys = [F.expr(upper_trim("akun")), _key_text("id_konten"), F.to_date("tanggal")]
    return latest_per_key(bronze, keys, _newest(*tie_breaks))


def production_dedup(silver: DataFrame, tie_breaks: tuple[str, ...] = ("akun",)) -> DataFrame:
    """Latest production row per content id."""
    order = [F.desc("tanggal"), *[F.desc(t) for t in tie_breaks]]
    return latest_per_key(silver, [F.col("id_konten")], order)


def first_by_hash(df: DataFrame, order: list[Column]) -> DataFrame:
    """Of rows with one `row_hash_raw` the first in `order` stays. Hashes differ from their first characters on:
    another hash of them would only make the shuffled rows wider."""
    return _first(df, [F.col("row_hash_raw")], order)
