"""Incremental per-user state for the history-wide operators.

Acquisition, retention cohorts and the "never used the other service" DAU
segments need each user's first active day and every traffic source the user
was seen with, over the whole history. Recomputing that from the raw logs
rescans all of history every day; at scale the state is kept instead:

* ``first_seen`` (user_id, service, start): first active day per service;
* ``user_sources`` (user_id, source, start): every source a user has been seen
  with, and since when.

A daily update reads one day of logs (a pushed-down range scan), finds the
(user, service) and (user, source) pairs that the state does not know as of
that day with an anti join, and appends only those. Re-running a day appends
nothing; a day that comes late appends an earlier start, and readers take the
least start of a pair. Both tables hold at most a few rows per user.
The ``*_from_state`` operators give exactly the same rows as the full
recomputations in ``audience``.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions.columns import between_days, before_day_after

FEED, MESSENGER = "feed", "messenger"


def service_activity(feed: DataFrame, messages: DataFrame, first: date, last: date) -> DataFrame:
    """Distinct (user_id, service, action day, source) for days first..last."""
    def one(log, service):
        return log.where(between_days("time", first, last)).select(
            "user_id", F.lit(service).alias("service"), F.to_date("time").alias("action"), "source")
    return one(feed, FEED).unionByName(one(messages, MESSENGER)).distinct()


def initial_state(feed: DataFrame, messages: DataFrame, as_of: date) -> tuple[DataFrame, DataFrame]:
    """(first_seen, user_sources) from the whole history up to ``as_of`` (the one-off backfill)."""
    def one(log, service):
        return log.where(before_day_after("time", as_of)).select(
            "user_id", F.lit(service).alias("service"), F.to_date("time").alias("action"), "source")
    act = one(feed, FEED).unionByName(one(messages, MESSENGER))
    first_seen = act.groupBy("user_id", "service").agg(F.min("action").alias("start"))
    sources = act.groupBy("user_id", "source").agg(F.min("action").alias("start"))
    return first_seen, sources


def state_increment(first_seen: DataFrame, user_sources: DataFrame, feed: DataFrame, messages: DataFrame,
                    day: date) -> tuple[DataFrame, DataFrame]:
    """Rows to append for ``day``: pairs that the state does not hold with a start up to that day."""
    act = service_activity(feed, messages, day, day)
    new_first = (
        act.select("user_id", "service").distinct()
        .join(first_seen.where(F.col("start") <= F.lit(day)), ["user_id", "service"], "left_anti")
        .withColumn("start", F.lit(day))
    )
    new_sources = (
        act.select("user_id", "source").distinct()
        .join(user_sources.where(F.col("start") <= F.lit(day)), ["user_id", "source"], "left_anti")
        .withColumn("start", F.lit(day))
    )
    return new_first, new_sources


def write_state(first_seen: DataFrame, user_sources: DataFrame, root: str, mode: str = "append") -> None:
    first_seen.select("user_id", "service", "start").write.mode(mode).partitionBy("start").parquet(f"{root}/first_seen")
    user_sources.select("user_id", "source", "start").write.mode(mode).parquet(f"{root}/user_sources")


def read_state(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    fs = spark.read.schema("user_id bigint, service string, start date").parquet(f"{root}/first_seen")
    us = spark.read.schema("user_id bigint, source string, start date").parquet(f"{root}/user_sources")
    return fs.select("user_id", "service", "start"), us


def update_state(spark: SparkSession, root: str, feed: DataFrame, messages: DataFrame, day: date) -> None:
    """Append ``day``'s new pairs to the state under ``root`` (idempotent)."""
    fs, us = read_state(spark, root)
    new_first, new_sources = state_increment(fs, us, feed, messages, day)
    write_state(new_first, new_sources, root)


def _user_start(first_seen: DataFrame, as_of: date) -> DataFrame:
    return first_seen.where(F.col("start") <= F.lit(as_of)).groupBy("user_id").agg(F.min("start").alias("start"))


def acquisition_from_state(first_seen: DataFrame, user_sources: DataFrame, as_of: date) -> DataFrame:
    """New users per (first day, source), today excluded: same rows as ``audience.acquisition_by_source``."""
    return (
        _user_start(first_seen, as_of)
        .join(user_sources.where(F.col("start") <= F.lit(as_of)).select("user_id", "source").distinct(), "user_id")
        .groupBy("start", "source").agg(F.count("user_id").alias("new_users"))
        .where(F.col("start") != F.lit(as_of))
    )


def retention_from_state(feed: DataFrame, messages: DataFrame, first_seen: DataFrame, as_of: date,
                         days: int = 7) -> DataFrame:
    """Same rows as ``audience.retention_cohorts``, reading only the last ``days`` + 1 days of logs."""
    first = as_of - timedelta(days=days)
    recent = service_activity(feed, messages, first, as_of).select("user_id", "action", "source").distinct()
    cohort = _user_start(first_seen, as_of).where(F.col("start") >= F.lit(first))
    return (
        recent.join(cohort, "user_id")
        .groupBy("action", "start", "source").agg(F.count("user_id").alias("users"))
    )


def dau_only_feed_from_state(feed: DataFrame, first_seen: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Same rows as ``audience.dau_only_feed`` without rescanning the messenger history."""
    from pulsekit.operators.audience import ONLY_FEED, trailing_window
    first, last = trailing_window(as_of, days)
    messengers = first_seen.where((F.col("service") == MESSENGER) & (F.col("start") <= F.lit(as_of))).select("user_id")
    days_ = feed.where(between_days("time", first, last)).select(F.to_date("time").alias("date"), "user_id").distinct()
    return (
        days_.join(messengers, "user_id", "left_anti")
        .groupBy("date").agg(F.count("user_id").alias("dau"))
        .select("date", F.lit(ONLY_FEED).alias("app"), "dau")
    )


def save_state_tables(spark: SparkSession, first_seen: DataFrame, user_sources: DataFrame, database: str,
                      buckets: int, mode: str = "append") -> tuple[str, str]:
    """Keep the state as catalog tables bucketed (and sorted) by ``user_id``.

    With the same bucket count on both tables, the per-user aggregate and the
    first_seen x user_sources join of ``acquisition_from_state`` read
    co-located buckets and need no shuffle. Appends add files to the same
    buckets.
    """
    fs_t, us_t = f"{database}.user_first_seen", f"{database}.user_sources"
    (first_seen.select("user_id", "service", "start").write.mode(mode)
     .bucketBy(buckets, "user_id").sortBy("user_id").saveAsTable(fs_t))
    (user_sources.select("user_id", "source", "start").write.mode(mode)
     .bucketBy(buckets, "user_id").sortBy("user_id").saveAsTable(us_t))
    return fs_t, us_t


def append_day_to_tables(spark: SparkSession, database: str, buckets: int, feed: DataFrame, messages: DataFrame,
                         day: date) -> None:
    """Daily update of the bucketed state tables (idempotent, like ``update_state``)."""
    from pulsekit.session import shared_dir

    fs = spark.table(f"{database}.user_first_seen")
    us = spark.table(f"{database}.user_sources")
    new_first, new_sources = state_increment(fs, us, feed, messages, day)
    # Spark refuses to append to a table the same job reads: stage the (small)
    # increment as files in the shared checkpoint folder first.
    stage = shared_dir(spark, f"user-state-{day.isoformat()}")
    write_state(new_first, new_sources, stage, mode="overwrite")
    staged_first, staged_sources = read_state(spark, stage)
    save_state_tables(spark, staged_first, staged_sources, database, buckets, mode="append")


# ---------------------------------------------------------------- app daily actions from state
def day_counts(feed: DataFrame, messages: DataFrame, first: date, last: date) -> DataFrame:
    """Messages, likes and views per day for days first..last (one pushed-down range scan each)."""
    msgs = messages.where(between_days("time", first, last)).groupBy(F.to_date("time").alias("date")).agg(
        F.count("user_id").alias("messages"))
    acts = feed.where(between_days("time", first, last)).groupBy(F.to_date("time").alias("date")).agg(
        F.count_if(F.col("action") == "like").alias("likes"),
        F.count_if(F.col("action") == "view").alias("views"),
        F.count_distinct("user_id").alias("feed_dau"),
    )
    return msgs.join(acts, "date", "full_outer").select(
        "date", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("messages", "likes", "views", "feed_dau")])


def post_first_seen_initial(feed: DataFrame, as_of: date) -> DataFrame:
    return feed.where(before_day_after("time", as_of)).groupBy("post_id").agg(F.min(F.to_date("time")).alias("start"))


def post_first_seen_increment(post_first_seen: DataFrame, feed: DataFrame, day: date) -> DataFrame:
    """Posts seen on ``day`` that the state does not hold with a start up to that day."""
    return (
        feed.where(between_days("time", day, day)).select("post_id").distinct()
        .join(post_first_seen.where(F.col("start") <= F.lit(day)), "post_id", "left_anti")
        .withColumn("start", F.lit(day))
    )


def write_daily_state(counts: DataFrame, posts: DataFrame, root: str) -> None:
    """Replace the loaded days of the counts table; append new posts (idempotent, like the user state)."""
    (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(f"{root}/day_counts"))
    posts.select("post_id", "start").write.mode("append").partitionBy("start").parquet(f"{root}/post_first_seen")


def read_daily_state(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    counts = spark.read.schema("messages bigint, likes bigint, views bigint, feed_dau bigint, date date").parquet(
        f"{root}/day_counts")
    posts = spark.read.schema("post_id int, start date").parquet(f"{root}/post_first_seen")
    return counts.select("date", "messages", "likes", "views", "feed_dau"), posts.select("post_id", "start")


def update_daily_state(spark: SparkSession, root: str, feed: DataFrame, messages: DataFrame, day: date) -> None:
    _, posts = read_daily_state(spark, root)
    write_daily_state(day_counts(feed, messages, day, day), post_first_seen_increment(posts, feed, day), root)


def app_daily_actions_from_state(counts: DataFrame, post_first_seen: DataFrame, as_of: date) -> DataFrame:
    """Same rows as ``audience.app_daily_actions`` from the per-day counts and post state."""
    posts = (
        post_first_seen.groupBy("post_id").agg(F.min("start").alias("start")).where(F.col("start") < F.lit(as_of))
        .groupBy(F.col("start").alias("date")).agg(F.count("post_id").alias("posts"))
    )
    return (
        counts.where(F.col("date") < F.lit(as_of))
        .join(posts, "date", "full_outer")
        .select("date", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                          for c in ("messages", "likes", "views", "posts")])
    )


def dau_only_messenger_from_state(messages: DataFrame, first_seen: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Same rows as ``audience.dau_only_messenger`` without rescanning the feed history."""
    from pulsekit.operators.audience import ONLY_MESSENGER, trailing_window
    first, last = trailing_window(as_of, days)
    feeders = first_seen.where((F.col("service") == FEED) & (F.col("start") <= F.lit(as_of))).select("user_id")
    window = messages.where(between_days("time", first, last))
    only = (
        window.select(F.to_date("time").alias("date"), "user_id").distinct()
        .join(feeders, "user_id", "left_anti")
        .groupBy("date").agg(F.count("user_id").alias("dau"))
    )
    active_days = window.select(F.to_date("time").alias("date")).distinct()
    return only.join(active_days, "date", "full_outer").select(
        "date", F.lit(ONLY_MESSENGER).alias("app"), F.coalesce("dau", F.lit(0)).cast("bigint").alias("dau"))


def dau_segments_from_state(feed: DataFrame, messages: DataFrame, first_seen: DataFrame, as_of: date,
                            days: int = 7) -> DataFrame:
    """Same rows as ``audience.dau_segments``: the window logs plus the first-seen state."""
    from pulsekit.operators.audience import dau_both_services
    return (
        dau_both_services(feed, messages, as_of, days)  # needs the window only
        .unionByName(dau_only_feed_from_state(feed, first_seen, as_of, days))
        .unionByName(dau_only_messenger_from_state(messages, first_seen, as_of, days))
    )


def app_report_from_state(feed: DataFrame, messages: DataFrame, first_seen: DataFrame, user_sources: DataFrame,
                          counts: DataFrame, post_first_seen: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Same rows as ``reports.app_report_latest``, reading only the window of logs plus state."""
    from pulsekit.plans.reports import app_report_figures
    return app_report_figures(
        acquisition_from_state(first_seen, user_sources, as_of),
        dau_segments_from_state(feed, messages, first_seen, as_of, days),
        app_daily_actions_from_state(counts, post_first_seen, as_of),
    )


def feed_history_from_state(counts: DataFrame, as_of: date) -> DataFrame:
    """Same rows as ``audience.feed_history_metrics`` from the per-day counts
    (days without feed activity are not rows there either)."""
    return counts.where((F.col("date") < F.lit(as_of)) & ((F.col("views") + F.col("likes")) > 0)).select(
        "date", F.col("feed_dau").alias("dau"), "views", "likes",
        F.bround(F.try_divide((F.col("likes") * 100).cast("double"), F.col("views").cast("double")), 1).alias("ctr"))


def retention_rate_from_state(feed: DataFrame, messages: DataFrame, first_seen: DataFrame, as_of: date,
                              cohorts: int = 20) -> DataFrame:
    """Same rows as ``audience.retention_rate_by_source``, reading only the last ``cohorts`` + 1 days of logs."""
    from pulsekit.operators.audience import retention_rate_from_counts
    counts = retention_from_state(feed, messages, first_seen, as_of, cohorts).where(F.col("start") < F.lit(as_of))
    return retention_rate_from_counts(counts.select("start", "source", "action", "users"))
