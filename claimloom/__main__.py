"""Batch job: ``spark-submit`` entry that builds all tables from the catalog."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from claimloom.payer import DEFAULT_PROFILE
from claimloom.plans.build import build, staging_views
from claimloom.plans.stored_views import drop_intermediate_views, store_intermediate_views
from claimloom.sources.tables import (
    MEDICAL_CLAIMS,
    Layers,
    TableSink,
    is_bucketed_by,
    newest_delivery,
    raw_from_catalog,
    store_staging_views,
)


def main(argv: list[str] | None = None) -> int:
    layers = Layers.of(DEFAULT_PROFILE)
    parser = argparse.ArgumentParser(description="Build the claims tables.")
    parser.add_argument("--raw-database", default=layers.raw)
    parser.add_argument("--staging-database", default=layers.staging)
    parser.add_argument("--intermediate-database", default=layers.intermediate)
    parser.add_argument("--final-database", default=layers.final)
    how = parser.add_mutually_exclusive_group()
    how.add_argument("--store-intermediate", action="store_true", help="intermediate rows as tables")
    how.add_argument("--intermediate-views", action="store_true", help="intermediate relations as stored views")
    parser.add_argument("--hold-final", action="store_true", help="publish no table that fails a final check")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    raw = raw_from_catalog(spark, args.raw_database)
    store_staging_views(spark, args.raw_database, args.staging_database, staging_views())
    if args.intermediate_views:
        store_intermediate_views(spark, args.staging_database, args.intermediate_database)
    if args.store_intermediate:
        drop_intermediate_views(spark, args.intermediate_database)
    newest = {
        name: date
        for name in raw
        if (date := newest_delivery(spark, f"{args.raw_database}.{name}")) is not None
    }
    report = build(
        raw,
        TableSink(spark, args.final_database),
        newest=newest,
        intermediate_sink=TableSink(spark, args.intermediate_database) if args.store_intermediate else None,
        hold_final=args.hold_final,
        clustered=[
            name for name in [MEDICAL_CLAIMS]
            if is_bucketed_by(spark, f"{args.raw_database}.{name}", "int_clm_num")
        ],
    )
    for check in report.checks:
        verdict = "FAIL" if check.failures else "ok"
        print(f"{verdict} {check.layer} {check.table_name}.{check.column_name}: {check.failures}")
    for name, reason in report.skipped.items():
        print(f"SKIPPED {name}: {reason}")
    for name, error in report.errors.items():
        print(f"ERROR {name}: {error.splitlines()[0]}")
    return 0 if report.ok else 1


if __name__ == "__main__":
    sys.exit(main())
