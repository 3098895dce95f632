"""Command line for the monthly feeds: build, score, load, report.

    python -m ledgerloom.plans.run tariff --drop 'landing/tariff_*.csv' \\
        --target warehouse/tariff --anomalies warehouse/anomalies --findings warehouse/dq

With ``--year/--month`` one month is scored against its three previous months
in the target and then replaces that month. Without them every month of the
drop is loaded at once and the whole target is scored (backfill).

Side tables (store directory, role dictionary, rate card, sales) are read from
Parquet or, for paths ending in ``.csv``, from headered CSV.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.enrich import store_directory
from ledgerloom.plans import monthly
from ledgerloom.session import get_spark

FEEDS = ("tariff", "store-costs", "dc-costs", "meter", "accounts", "labor")


def _read(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".csv"):
        return spark.read.option("header", "true").csv(path)
    return spark.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018 - listing only, no data read
        return True
    except Exception:
        return False


def build(spark: SparkSession, args: argparse.Namespace) -> monthly.FeedRun:
    feed = args.feed
    if feed == "tariff":
        return monthly.tariff_drop(spark, args.drop, fmt=args.format)
    if feed == "store-costs":
        return monthly.store_costs_drop(spark, args.drop)
    if feed == "dc-costs":
        return monthly.dc_costs_drop(spark, args.drop)
    directory = store_directory(_read(spark, args.directory))
    if feed == "meter":
        return monthly.meter_drop(spark, args.drop, directory, sep=args.sep)
    if feed == "accounts":
        return monthly.accounts_drop(spark, args.drop, directory, fmt=args.format)
    if feed == "labor":
        return monthly.labor_drop(spark, args.drop, _read(spark, args.roles),
                                  _read(spark, args.rate_card), directory,
                                  _read(spark, args.sales), args.rate_column, fmt=args.format)
    raise ValueError(feed)


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    feed_run = build(spark, args)
    c = feed_run.contract
    one_month = args.year is not None and args.month is not None
    history = spark.read.parquet(args.target) if _exists(spark, args.target) else None
    anomalies = None
    if one_month and history is not None:
        # the history read covers the three months before the one being loaded,
        # so replacing that month does not change what is scored
        anomalies = monthly.score(feed_run, history, args.year, args.month)
        if args.anomalies:
            anomalies.write.mode("append").parquet(args.anomalies)
    if args.findings:  # before the load, while the target still is the history
        monthly.full_report(feed_run, history, args.year, args.month, anomalies) \
            .withColumn("loaded_at", F.current_timestamp()).write.mode("append").parquet(args.findings)
    observed = monthly.load(feed_run, args.target, args.year, args.month)
    if not one_month:
        anomalies = monthly.score_history(spark.read.parquet(args.target), c)
        if args.anomalies:
            anomalies.write.mode("overwrite").parquet(args.anomalies)
    if observed is not None and args.findings:
        observed.where("check = 'rows'").withColumn("loaded_at", F.current_timestamp()) \
            .write.mode("append").parquet(args.findings)
    return {"feed": c.name, "target": args.target}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerloom.plans.run", description=__doc__.splitlines()[0])
    p.add_argument("feed", choices=FEEDS)
    p.add_argument("--drop", required=True, help="path or glob of the landed drop(s)")
    p.add_argument("--target", required=True, help="partitioned Parquet target")
    p.add_argument("--year", type=int)
    p.add_argument("--month", type=int)
    p.add_argument("--anomalies", help="where to write the anomaly table")
    p.add_argument("--findings", help="where to append the data-quality findings")
    p.add_argument("--format", default="csv", help="format of headered drops (csv/parquet)")
    p.add_argument("--sep", default=",", help="separator of meter CSV drops")
    p.add_argument("--directory", help="store directory (id, name, AccountantNumber, MVZ)")
    p.add_argument("--roles", help="role dictionary")
    p.add_argument("--rate-card", help="hourly rate card")
    p.add_argument("--rate-column", help="rate column of the card (its name changes per card)")
    p.add_argument("--sales", help="sales fact (filid, depid, year, month, type_oper, sumout)")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = get_spark()
    print(run(spark, args))
    return 0


if __name__ == "__main__":
    sys.exit(main())
