"""Left join to a table with unique keys that stays even when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it has at least HOT_SHARE of all rows and MIN_ROWS of them, so at most
# 1 / HOT_SHARE keys are, and the table of hot keys may always be broadcast.
HOT_SHARE = 0.001
MIN_ROWS = 10_000
TRACKED = 32768
MAX_HOT = 1000
FAN_OUT = 64


def hot_keys(
    df: DataFrame,
    key: str,
    max_hot: int = MAX_HOT,
    tracked: int = TRACKED,
    min_rows: int = MIN_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """(_hot, _salts): frequent values of `key` by their counts in a fixed-size sketch.

    One pass over one column, never more than `max_hot` rows. A key gets `fan_out` salts, or
    one per HOT_SHARE of the rows it holds if those are more. A value missed or listed
    needlessly only moves work around, it cannot change a join result.
    """
    top = df.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {max_hot}, {tracked})").alias("top"),
        F.count("*").alias("_rows"),
    )
    share = F.col("_rows") * HOT_SHARE
    return (
        top.select("_rows", F.explode("top").alias("t"))
        .where((F.col("t.count") >= share) & (F.col("t.count") >= min_rows))
        .select(
            F.col("t.item").alias("_hot"),
            F.greatest(F.lit(fan_out), F.ceil(F.col("t.count") / share).cast("int")).alias("_salts"),
        )
    )


def left_join_unique(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread: list[str],
    fan_out: int = FAN_OUT,
    max_hot: int = MAX_HOT,
    tracked: int = TRACKED,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """`left LEFT JOIN right ON left_key = right_key`, `right_key` unique in `right`.

    Rows with a hot key are spread over the key's salts by a hash of the `spread`
    columns, and the one matching right row of each hot key is repeated per salt.
    Rows with a null key match nothing and are spread the same way. The salt is a
    function of the row, so a recomputed task sends every row where it went before.
    """
    hot = F.broadcast(hot_keys(left, left_key, max_hot, tracked, min_rows, fan_out))
    # Null keys match nothing and are spread as widely as by `fan_out`.
    salt = F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(fan_out))).cast("int")

    salted_left = (
        left.join(hot, F.col(left_key) == F.col("_hot"), "left")
        .withColumn(
            "_salt",
            F.when(F.col("_hot").isNotNull() | F.col(left_key).isNull(), salt).otherwise(0),
        )
        .drop("_hot", "_salts")
    )
    salts = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(
        F.array(F.lit(0))
    )
    salted_right = (
        right.join(hot, F.col(right_key) == F.col("_hot"), "left")
        .withColumn("_right_salt", F.explode(salts))
        .drop("_hot", "_salts")
    )
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_right_salt"))
    return salted_left.join(salted_right, on, "left").drop("_salt", "_right_salt")
