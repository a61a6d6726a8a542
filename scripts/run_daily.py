"""Daily job: load the metrics mart, update the history state, write report data.

Submit on a cluster, e.g.
  spark-submit --py-files pulsekit.zip scripts/run_daily.py \\
      --feed analytics.feed_actions --messages analytics.message_actions \\
      --as-of 2024-01-31 --mart analytics.metrics_mart --state <shared>/state --reports <shared>/reports

Logs are catalog tables or folders (``--format`` for files). Every write is
idempotent, so the scheduler may retry or backfill any date.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date, timedelta

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from pulsekit.plans import daily  # noqa: E402
from pulsekit.sources import FEED_SCHEMA, MESSAGE_SCHEMA, read_log  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--feed", required=True)
    ap.add_argument("--messages", required=True)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--as-of", required=True, type=date.fromisoformat)
    ap.add_argument("--mart", required=True, help="folder or catalog table")
    ap.add_argument("--state", required=True, help="shared folder of the history state")
    ap.add_argument("--reports", help="shared folder for report data (Parquet per dataset)")
    ap.add_argument("--date-partition", help="date partition column of the logs (enables partition pruning)")
    args = ap.parse_args()

    spark = SparkSession.builder.appName("pulsekit-daily").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    feed = read_log(spark, args.feed, FEED_SCHEMA, format=args.format)
    messages = read_log(spark, args.messages, MESSAGE_SCHEMA, format=args.format)
    day_feed, day_messages = feed, messages
    if args.date_partition:  # the mart and the state update only need the processed day
        day = args.as_of - timedelta(days=1)
        day_feed = read_log(spark, args.feed, FEED_SCHEMA, format=args.format,
                            date_partition=args.date_partition, days=(day, day))
        day_messages = read_log(spark, args.messages, MESSAGE_SCHEMA, format=args.format,
                                date_partition=args.date_partition, days=(day, day))
    daily.load_daily_mart(spark, day_feed, day_messages, args.as_of, args.mart)
    daily.update_history(spark, feed, messages, args.as_of, args.state, day_feed, day_messages)
    if args.reports:
        recent_feed, recent_messages = feed, messages
        if args.date_partition:  # with the state, the reports need only the last 8 days of logs
            window = (args.as_of - timedelta(days=8), args.as_of)
            recent_feed = read_log(spark, args.feed, FEED_SCHEMA, format=args.format,
                                   date_partition=args.date_partition, days=window)
            recent_messages = read_log(spark, args.messages, MESSAGE_SCHEMA, format=args.format,
                                       date_partition=args.date_partition, days=window)
        datasets = {**daily.app_report(spark, recent_feed, recent_messages, args.as_of, state_root=args.state),
                    **{f"feed_{k}": v for k, v in daily.feed_report(recent_feed, args.as_of).items()}}
        for name, df in datasets.items():
            df.write.mode("overwrite").parquet(f"{args.reports}/{args.as_of.isoformat()}/{name}")


if __name__ == "__main__":
    main()
