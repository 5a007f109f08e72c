"""Production run: prepare both sources and write every report.

    spark-submit --py-files collabstats.zip -m collabstats \\
        --users <parquet> --commits <root of year folders> \\
        [--users2 <parquet> --commits2 <parquet>] \\
        --prepared <folder> --out <folder> --year 2023

The session comes from the cluster (`getOrCreate`); `session.configure`
applies the AQE/skew/partition-size settings without overriding keys set by
the caller.  Raw commits are read from the year folders `<year>.0` (S3).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from collabstats.plans.jobs import Prepared, RawInputs, prepare_primary, prepare_reports, prepare_secondary, reports, write_reports
from collabstats.schemas import REPORT_YEARS
from collabstats.session import configure
from collabstats.sources.parquet import scan_year_folders


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="collabstats")
    ap.add_argument("--users", required=True)
    ap.add_argument("--commits", required=True, help="root folder holding <year>.0/ sub-folders of Parquet")
    ap.add_argument("--users2")
    ap.add_argument("--commits2")
    ap.add_argument("--prepared", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--year", type=int, default=REPORT_YEARS[-1])
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--buckets", type=int, default=0,
                    help="bucket the id-keyed prepared tables into this many buckets (default 0 = off; see README)")
    args = ap.parse_args(argv)
    if bool(args.users2) != bool(args.commits2):
        ap.error("a second source needs both --users2 and --commits2")

    spark = SparkSession.builder.appName("collabstats").getOrCreate()
    configure(spark)
    raw = RawInputs(
        users=spark.read.parquet(args.users),
        commits=scan_year_folders(spark, args.commits),
        users_secondary=spark.read.parquet(args.users2) if args.users2 else None,
        commits_secondary=spark.read.parquet(args.commits2) if args.commits2 else None,
    )
    prepared = prepare_primary(spark, raw, Prepared(args.prepared, buckets=args.buckets or None))
    if raw.users_secondary is not None:
        prepared = prepare_secondary(spark, raw, prepared)
    prepared = prepare_reports(spark, prepared, args.year)
    return write_reports(reports(spark, prepared, args.year), args.out, args.format)


if __name__ == "__main__":
    main()
