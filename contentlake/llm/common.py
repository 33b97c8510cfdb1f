"""What the operators here share: tables, words, staged tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contentlake.session import tune

#: A word is a run of anything but space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

T = TypeVar("T")

_OWN_ROOT: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`, which all executors see. A local master may do without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN_ROOT:
        _OWN_ROOT.append(tempfile.mkdtemp(prefix="contentlake-llm-"))
    return _OWN_ROOT[0]


#: Lists that take the paths made while they are open; see `recorded`.
_RECORDS: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Adds to `paths` what is staged meanwhile, for a caller who knows when nothing reads it any more."""
    _RECORDS.append(paths)
    try:
        yield
    finally:
        _RECORDS.pop()


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    for paths in _RECORDS[-1:]:
        paths.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: a cut of the lineage that survives
    lost executors, and one computation for several readers."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a number for each row, staged, so that every reader sees the same numbers; and the
    name of that column, which none of `docs` has."""
    name = free_name(docs, "_row")
    return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def with_key(docs: DataFrame, id_col: str, *others: str) -> tuple[DataFrame, str]:
    """`docs` with a row's id and a hash of its other columns, and the name of that column: rows of one
    key are equal in what a decision on them reads."""
    name = free_name(docs, "_key")
    return docs.withColumn(name, F.struct(F.col(id_col).alias("id"), F.xxhash64(*others).alias("row"))), name


def without(keyed: DataFrame, out: DataFrame, key: str) -> DataFrame:
    """`keyed` less the rows whose `key` (see `with_key`) is in `out`, and less that column."""
    gone = out.select(F.col(f"{key}.id").alias("_gone_id"), F.col(f"{key}.row").alias("_gone_row")).distinct()
    same = keyed[f"{key}.id"].eqNullSafe(gone["_gone_id"]) & (keyed[f"{key}.row"] == gone["_gone_row"])
    return keyed.join(gone, same, "left_anti").drop(key)


def text_bytes(text_col: str = "text") -> Column:
    """UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))


#: The vocabulary a worker process holds, under its class and path; see `of_worker`.
_HELD: dict[tuple, object] = {}


def of_worker(make: Callable[..., T], *args: str) -> T:
    """`make(*args)`, kept by a worker process until it asks for another: processes outlive a stage, so one vocabulary
    and what was learnt by it are held at a time."""
    if (make, *args) not in _HELD:
        _HELD.clear()
        _HELD[make, *args] = make(*args)
    return _HELD[make, *args]


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Cuts of about `size` bytes that end at white space, so that no word is cut."""
    start, end = 0, len(data)
    while end - start > size:
        cut = start + size
        while cut < end and data[cut] not in b" \t\n\v\f\r":
            cut += 1
        yield data[start:cut]
        start = cut
    yield data[start:end]
