"""Run the batch jobs: ``spark-submit`` or ``python -m pulsemart <job> --out DIR [--csv DIR]``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from pulsemart import jobs
from pulsemart.plans.marts import mart_summary
from pulsemart.session import SETTINGS
from pulsemart.sources import scan_csv_tables


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pulsemart", description=__doc__)
    parser.add_argument("job", choices=["clean", "marts", "model", "summary", "all"])
    parser.add_argument("--out", required=True, help="folder of clean tables, marts and model outputs")
    parser.add_argument("--csv", help="folder of the six CSV files; needed by clean and all")
    args = parser.parse_args(argv)
    if args.job in ("clean", "all") and not args.csv:
        parser.error("--csv is needed to clean")

    builder = SparkSession.builder.appName(f"pulsemart-{args.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.job in ("clean", "all"):
        raw = scan_csv_tables(spark, args.csv, target=f"{args.out.rstrip('/')}/raw", skip_existing=False)
        jobs.clean_job(raw, args.out)
    if args.job in ("marts", "all"):
        jobs.mart_job(spark, args.out)
    if args.job in ("model", "all"):
        jobs.model_job(spark, args.out)
    if args.job in ("summary", "all"):
        mart_summary(jobs.report_tables(spark, args.out)["mart_tenant_health"]).show(vertical=True, truncate=False)


if __name__ == "__main__":
    main()
