"""Folders of versions v=1, v=2, …: a version counts once its marker file is there.

The marker is the last thing written, so a writer that dies half-way leaves the newest
complete version in force, and readers never see a table that is being replaced.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from contentlake.sources.files import child_names, exists, remove

DONE = "_SUCCESS"  # Spark's own marker, written when all tasks have committed


def versions(spark: SparkSession, path: str) -> list[int]:
    """All version numbers, complete or not, in order."""
    return sorted(int(n[2:]) for n in child_names(spark, path) if n.startswith("v="))


def complete(spark: SparkSession, path: str, marker: str = DONE) -> list[int]:
    return [v for v in versions(spark, path) if exists(spark, f"{path}/v={v}/{marker}")]


def latest(spark: SparkSession, path: str, marker: str = DONE) -> int | None:
    for v in reversed(versions(spark, path)):
        if exists(spark, f"{path}/v={v}/{marker}"):
            return v
    return None


def following(spark: SparkSession, path: str) -> int:
    """A number no version has, broken ones included."""
    return max(versions(spark, path), default=0) + 1


def prune(spark: SparkSession, path: str, keep: int, marker: str = DONE) -> list[int]:
    """Delete all but the newest `keep` complete versions, and broken ones before the newest."""
    done = complete(spark, path, marker)
    stay = set(done[-keep:])
    gone = [v for v in versions(spark, path) if done and v < done[-1] and v not in stay]
    for v in gone:
        remove(spark, f"{path}/v={v}")
    return gone
