"""``python -m hitledger <job> ...`` or through ``spark-submit``; one job per call."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from hitledger.plans import exports, jobs, refresh
from hitledger.session import SETTINGS
from hitledger.sources.dimensions import ci_prefixes, read_secret, registries


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="hitledger", description=__doc__)
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=None, help="default: now, UTC")
    job = parser.add_subparsers(dest="job", required=True)

    parse = job.add_parser("parse", help="bring the parsed table up to date")
    parse.add_argument("store")
    parse.add_argument("--dir", help="folder of logs; recent access logs are selected")
    parse.add_argument("--key-file")
    parse.add_argument("files", nargs="*", help="or an explicit list of files")

    report = job.add_parser("report", help="downloads per day as CSV")
    for name in ("store", "prefixes", "registries", "output"):
        report.add_argument(name)
    report.add_argument("--key-file", help="the key of the store, to heal damaged parts")

    sanitize = job.add_parser("sanitize", help="export the parsed table without addresses")
    sanitize.add_argument("store")
    sanitize.add_argument("output")
    sanitize.add_argument("--key-file", help="the key of the store, to heal damaged parts")
    sanitize.add_argument("--format", choices=["parquet", "csv"], default="parquet")

    anonymize = job.add_parser("anonymize", help="mask addresses, hashes and times of a log")
    anonymize.add_argument("source")
    anonymize.add_argument("output")
    anonymize.add_argument("--key-file", required=True)
    anonymize.add_argument("--seed", default=None, help="default: a fresh one for each run")

    tidy = job.add_parser("tidy", help="find damaged rows, remove superseded runs")
    tidy.add_argument("store")

    mirror = job.add_parser("mirror", help="bytes a mirror served in the last 30 days")
    mirror.add_argument("logs")
    mirror.add_argument("cache")

    look = job.add_parser("look", help="distinct clients and packages of a log")
    look.add_argument("path")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    builder = SparkSession.builder.appName(f"hitledger-{args.job}")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    as_of = args.as_of or datetime.now(UTC).replace(tzinfo=None)
    if args.job == "parse":
        if args.dir:
            print(jobs.parse_directory(spark, args.dir, args.store, as_of, args.key_file), "files parsed")
        else:
            print(jobs.parse_files(spark, args.files, args.store, args.key_file), "files parsed")
        report = jobs.parse_report(spark, args.store, args.dir, args.key_file)
        for title, table in (("not readable", report.unreadable), ("no date in the name", report.undated)):
            for row in table.limit(100).collect():
                print(f"{title}: {row.src_path}")
        report.rejects.show(50, truncate=False)
    elif args.job == "tidy":
        print("{} files to parse again, {} runs removed".format(*jobs.tidy(spark, args.store)))
    elif args.job == "report":
        registry, prefixes = registries(spark, args.registries), ci_prefixes(spark, args.prefixes)
        reports = jobs.stored_reports(spark, args.store, prefixes, registry, args.output, as_of, args.key_file)
        reports.totals.show()
        reports.top_packages(registry).orderBy("package_uuid", "day").show(400, truncate=False)
        print(reports.package_csv, reports.artifact_csv, sep="\n")
    elif args.job == "sanitize":
        secret = read_secret(spark, args.key_file) if args.key_file else b""
        exports.write_sanitized(refresh.read_rows(spark, args.store, secret=secret), args.output, args.format)
    elif args.job == "anonymize":
        key = read_secret(spark, args.key_file).hex()
        jobs.anonymize_file(spark, args.source, args.output, key, args.seed)
    elif args.job == "mirror":
        per_day, total = jobs.mirror_traffic(spark, args.logs, args.cache, as_of)
        per_day.orderBy("day").show(40)
        total.show(truncate=False)
    else:
        jobs.quick_look(spark, args.path).show()
    spark.stop()


if __name__ == "__main__":
    main()
