"""Gold: the denormalised daily fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.operators.latest import production_dedup
from contentlake.operators.skew import FAN_OUT, left_join_unique
from contentlake.specs import GOLD_DIMENSION, GOLD_FACT, SILVER_VIDEO_KEYS

_TIE_BREAKS = ("akun", "row_hash_clean")


def gold_fact(
    silver_video: DataFrame, silver_production: DataFrame, fan_out: int = FAN_OUT
) -> DataFrame:
    """Video rows with the latest production row of their content id."""
    ties = tuple(c for c in _TIE_BREAKS if c in silver_production.columns)
    dim = production_dedup(silver_production, ties).select(
        F.col("id_konten").alias("_id_konten"),
        *[F.col(src).alias(f"_dim_{out}") for out, src in GOLD_DIMENSION],
    )
    spread = [*SILVER_VIDEO_KEYS]
    spread += [c for c in ("run_id", "row_hash_raw") if c in silver_video.columns]
    joined = left_join_unique(silver_video, dim, "id_video", "_id_konten", spread, fan_out)
    return joined.select(
        *[F.col(src).alias(out) for out, src in GOLD_FACT],
        *[F.col(f"_dim_{out}").alias(out) for out, _ in GOLD_DIMENSION],
    )
