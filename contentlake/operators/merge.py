"""MERGE as a join: update matched rows whose hash changed, insert unmatched ones.

Plain parquet tables take no `MERGE INTO`, so the result of the merge is computed as
a full outer equi-join; `sources.tables` writes the touched partitions back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.functions.text import upper_trim
from contentlake.specs import (
    LINEAGE,
    SILVER_PRODUCTION_COLUMNS,
    SILVER_PRODUCTION_KEYS,
    SILVER_VIDEO_COLUMNS,
    SILVER_VIDEO_KEYS,
)

INSERT, UPDATE, UNCHANGED, KEEP = "insert", "update", "unchanged", "keep"
HASH = "row_hash_clean"


@dataclass(frozen=True)
class MergeSpec:
    columns: tuple[str, ...]  # all columns of the table, in order
    keys: tuple[str, ...]  # never updated
    exact_keys: tuple[str, ...]  # matched with `=`: null matches nothing
    blank_keys: tuple[str, ...]  # matched as coalesce(key, '')
    clean_target: tuple[str, ...] = ()  # keys upper-trimmed on the target side

    def key(self, name: str, side: str, null_safe: bool) -> str:
        c = f"{side}.{name}"
        if side == "t" and name in self.clean_target:
            c = upper_trim(c)
        if name in self.blank_keys or (null_safe and name != "tanggal"):
            c = f"coalesce({c}, '')"
        return c

    def match(self, null_safe: bool) -> str:
        keys = (*self.exact_keys, *self.blank_keys)
        return " AND ".join(
            f"{self.key(k, 't', null_safe)} = {self.key(k, 's', null_safe)}" for k in keys
        )


VIDEO_MERGE = MergeSpec(
    columns=(*SILVER_VIDEO_COLUMNS, *LINEAGE, HASH),
    keys=SILVER_VIDEO_KEYS,
    exact_keys=("tanggal", "toko"),
    blank_keys=("id_kreator", "id_video"),
)
PRODUCTION_MERGE = MergeSpec(
    columns=(*SILVER_PRODUCTION_COLUMNS, *LINEAGE, HASH),
    keys=SILVER_PRODUCTION_KEYS,
    exact_keys=("tanggal", "akun"),
    blank_keys=("id_konten",),
    clean_target=("akun", "id_konten"),
)


def merge_plan(
    target: DataFrame, source: DataFrame, spec: MergeSpec, null_safe: bool = False
) -> DataFrame:
    """The table after the merge, plus `action` per row.

    `source` must hold one row per key. `null_safe` also matches null text keys
    (in the default mode such rows are inserted again by every merge).
    """
    columns = [c for c in spec.columns if c in source.columns]
    t = target.selectExpr(*columns, "true AS in_t").alias("t")
    s = source.selectExpr(*columns, "true AS in_s").alias("s")
    # A null hash on either side compares to null: no update.
    action = (
        f"CASE WHEN in_t IS NULL THEN '{INSERT}' WHEN in_s IS NULL THEN '{KEEP}' "
        f"WHEN t.{HASH} <> s.{HASH} THEN '{UPDATE}' ELSE '{UNCHANGED}' END AS action"
    )

    def result(c: str) -> str:
        takes = f"action = '{INSERT}'" if c in spec.keys else f"action IN ('{INSERT}', '{UPDATE}')"
        return f"if({takes}, s.{c}, t.{c}) AS {c}"

    joined = t.join(s, F.expr(spec.match(null_safe)), "full_outer")
    return joined.selectExpr("t.*", "s.*", action).selectExpr(
        *[result(c) for c in columns], "action"
    )


def merge_actions(plan: DataFrame) -> DataFrame:
    """Rows per merge branch."""
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))
