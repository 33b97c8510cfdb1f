"""Schema-only operators: rename, drop, de-duplicate columns, tag, union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentlake.functions.text import q, snake_case


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Normalise all names; of columns that end up with one name the first stays."""
    chosen: dict[str, str] = {}
    for name in df.columns:
        chosen.setdefault(snake_case(name), name)
    return df.selectExpr(*[f"{q(old)} AS {q(new)}" for new, old in chosen.items()])


def find_column(df: DataFrame, snake_name: str) -> str:
    """First column whose normalised name is `snake_name`."""
    for name in df.columns:
        if snake_case(name) == snake_name:
            return name
    raise KeyError(f"no column named like {snake_name!r}")


def drop_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.drop(*names)  # absent names are ignored


def tag_sources(df: DataFrame, registry: DataFrame, on: str = "sheet_name") -> DataFrame:
    """Attach the source id (`creds`) and the source order from a registry table.

    No hint: the registry is broadcast while its size is under Spark's threshold
    and shuffled beyond it.
    """
    return df.join(registry, on, "left")


def union_sheets(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column a sheet does not have is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_counts(df: DataFrame, by: str = "sheet_name") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
