"""The few Hadoop file-system calls the state and table writers need."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def create(spark: SparkSession, path: str, text: str) -> None:
    """A new small file, there as a whole or not at all; it is an error if there is one."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    folder, _, name = path.rpartition("/")
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.tmp")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(fresh, p):
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def folder_name(run_id: str) -> str:
    """A run id as a file name; different ids have different names."""
    return re.sub(r"[^A-Za-z0-9.-]", lambda m: f"_{ord(m[0]):x}_", run_id)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder with all it holds; False if there is none."""
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def has_files(spark: SparkSession, path: str) -> bool:
    """A table directory with at least one entry that is not a marker or temporary."""
    return any(not n.startswith(("_", ".")) for n in child_names(spark, path))


def scratch_dir(spark: SparkSession, fallback: str) -> str:
    """Shared folder for intermediate tables: the cluster's, or `fallback` if it names none."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback
