"""Landed spreadsheets: one row per sheet row, cells as an array of formatted text.

The header is a row of the data. Sheets may order, repeat or lack columns; all of them
are promoted in one plan, however many there are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.functions.text import snake_case

LANDING_SCHEMA = "sheet_name string, row_idx bigint, cells array<string>"
UNNAMED = "unnamed"


def read_landing(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Cell matrices as landed: JSON lines or parquet, schema never inferred."""
    return spark.read.schema(LANDING_SCHEMA).format(fmt).load(path)


def headers(cells: DataFrame, registry: DataFrame, header_row: int) -> DataFrame:
    """(sheet_name, creds, sheet_ord, header) of each sheet, blank names as 'unnamed'."""
    name = F.transform(
        "cells", lambda c: F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.lit(UNNAMED)).otherwise(c)
    )
    heads = cells.filter(F.col("row_idx") == header_row).select("sheet_name", name.alias("header"))
    return heads.join(registry, "sheet_name", "left").select("sheet_name", "creds", "sheet_ord", "header")


def header_names(heads: DataFrame) -> dict[str, list[str]]:
    """Columns over all sheets in order of first appearance, each with its spellings.

    Names that are equal once normalised are one column, shown as first spelt. This is
    schema: as many values as there are distinct header texts, never row data.
    """
    placed = heads.select("sheet_ord", F.posexplode("header").alias("pos", "name"))
    first = placed.groupBy("name").agg(F.min(F.struct("sheet_ord", "pos")).alias("first"))
    spellings: dict[str, list[str]] = {}
    for r in first.orderBy("first", "name").collect():
        spellings.setdefault(snake_case(r["name"]), []).append(r["name"])
    return {names[0]: names for names in spellings.values()}


def promote_headers(
    cells: DataFrame,
    registry: DataFrame,
    header_row: int,
    names: list[str] | None = None,
    stage: Callable[[DataFrame], DataFrame] = lambda heads: heads,
) -> DataFrame:
    """Named all-text columns, tagged with creds, sheet_name and the row's position.

    `names` fixes the column list; without it the names are read from the headers. Of a
    repeated header name the first counts; a name a sheet lacks is null.

    `stage` writes the headers, a row per sheet, and reads them back. Spark then knows how
    small they are and broadcasts them below its threshold, so that no cell is shuffled;
    without it their size is taken for that of the cells. Beyond the threshold the
    join shuffles with skew splitting.
    """
    heads = stage(headers(cells, registry, header_row))
    wanted = {n: [n] for n in names} if names is not None else header_names(heads)

    def position(spellings: list[str]) -> Column:
        found = F.array(*[F.nullif(F.array_position("header", F.lit(s)), F.lit(0)) for s in spellings])
        return F.array_min(found).cast("int")

    positions = heads.select(
        F.col("sheet_name").alias("_sheet"),
        "creds",
        "sheet_ord",
        *[position(s).alias(f"_p{i}") for i, s in enumerate(wanted.values())],
    )
    data = cells.filter(F.col("row_idx") > header_row)
    return data.join(positions, F.col("sheet_name") == F.col("_sheet"), "left").select(
        *[
            F.try_element_at("cells", F.col(f"_p{i}")).alias(n)
            for i, n in enumerate(wanted)
        ],
        "creds",
        "sheet_name",
        "sheet_ord",
        "row_idx",
    )
