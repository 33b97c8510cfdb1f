"""Command line of the daily job.

    spark-submit contentlake/jobs.py --lake <dir> --registry <dir> \
        --video <landed dir> --production <landed dir> --run-id <id> [--run-ts <ISO time>] [--null-safe] [--late]
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from contentlake.operators.watermark import REGISTRY_SCHEMA
from contentlake.plans.daily import Sheets, run_daily
from contentlake.sources.landing import read_landing
from contentlake.specs import PRODUCTION, VIDEO


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser()
    for name in ("--lake", "--registry", "--video", "--production", "--run-id"):
        p.add_argument(name, required=True)
    p.add_argument("--run-ts", default=None)
    p.add_argument("--format", default="json", choices=("json", "parquet"))
    p.add_argument("--null-safe", action="store_true")
    p.add_argument("--late", action="store_true")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("contentlake-daily").getOrCreate()
    registry = spark.read.schema(REGISTRY_SCHEMA).json(a.registry)
    sheets = {
        VIDEO.name: Sheets(read_landing(spark, a.video, a.format), registry),
        PRODUCTION.name: Sheets(read_landing(spark, a.production, a.format), registry),
    }
    ts = datetime.fromisoformat(a.run_ts) if a.run_ts else datetime.now(timezone.utc)
    for name, report in run_daily(spark, a.lake, sheets, ts, a.run_id, a.null_safe, a.late).items():
        print(name)
        report.show(truncate=False)


if __name__ == "__main__":
    main()
