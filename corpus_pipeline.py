"""The corpus pipeline: documents to token files in five stages.

Each stage works on all that the one before kept and returns the columns of documents; the
last one returns a row per row of its input, read back from the token files. A stage's
result is written before the next one is called, which then drops what the one before has staged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from contentlake.llm import decontaminate, mixing, quality_rules, simhash_dedup, token_output
from contentlake.llm.common import recorded, staged, table
from contentlake.sources.files import remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_STAGED: list[str] = []


def _stage(fn: Stage) -> Stage:
    """`fn` keeps the shared folder at what one stage needs: its `docs` are a written table, so no one
    reads what the stages before it have staged."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _STAGED:
            remove(spark, _STAGED.pop())
        with recorded(_STAGED):
            return fn(spark, docs, sf_dir)

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_rows(docs)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.corpus_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mix),
    ("token output", tokens),
]

#: SQL has neither the vocabularies nor the fingerprints; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
