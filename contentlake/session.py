"""Runtime SQL settings the plans here profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Validation projects some thirty text columns at once. Whole-stage code for that is one
# method too large for the JVM to compile, and interpreting it costs two to three times
# as much; past this size Spark splits the projection into small methods instead.
_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Tasks of bounded size, however large the input: these tables shrink to a tenth or less on disk, and what
    # a task sorts are their wide rows.
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Rows that go to Python in one batch: texts are held there and in the JVM's buffers.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Decimal text, and so every row hash, differs without it: zero would read 0E-9.
    "spark.sql.ansi.enabled": "true",
}
# For the wide rows of sheets. Spark joins small partitions up to the size above, but parts no large one for a sort:
# their first number has to be enough for it, whatever `spark.sql.shuffle.partitions` is.
_WIDE = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    # Every row is written several times on its way to gold, most of it hashes in hexadecimal and digits.
    "spark.sql.parquet.compression.codec": "zstd",
    # What a finished step has shuffled is read by no other, as all that is shared is staged.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession, wide: bool = False) -> SparkSession:
    for key, value in (_SETTINGS | (_WIDE if wide else {})).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
