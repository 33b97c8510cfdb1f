"""Append-only ledger of finished runs: one small file per run, in the order they finished.

A file is created, never replaced, and only once everything the run writes is in place. A run
that is in the ledger is over: its id is not taken for another.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from contentlake.sources.files import child_names, create, folder_name

LEDGER_SCHEMA = "seq bigint, run_id string, run_ts string"


def _entries(spark: SparkSession, path: str) -> list[str]:
    """Folder names of the run ids, first to last. A run a day is a few thousand names in ten years."""
    names = sorted(n for n in child_names(spark, path) if n.endswith(".json") and not n.startswith("."))
    return [n.removesuffix(".json").partition("-")[2] for n in names]


def finished(spark: SparkSession, path: str, run_id: str) -> bool:
    return folder_name(run_id) in _entries(spark, path)


def newest(spark: SparkSession, path: str) -> str | None:
    """Folder name of the run that finished last."""
    return next(reversed(_entries(spark, path)), None)


def record(spark: SparkSession, path: str, run_id: str, run_ts: str) -> int:
    """Add a finished run and return its place; one that is there already keeps its place."""
    entries, name = _entries(spark, path), folder_name(run_id)
    if name in entries:
        return entries.index(name) + 1
    seq = len(entries) + 1
    text = json.dumps({"seq": seq, "run_id": run_id, "run_ts": run_ts})
    create(spark, f"{path}/{seq:08d}-{name}.json", text + "\n")
    return seq


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not _entries(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(path)
