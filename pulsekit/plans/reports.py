"""Data part of the daily reports: latest-day figures and the weekly series.

Latest-day figures come from ``max_by(value, day)`` inside the aggregate
that reduces each base table, never from a driver-side lookup or a join of a
table back to its own maximum.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.operators import audience
from pulsekit.operators.pivots import REPORT_DATE_FORMAT, SERIES_FORMAT


def feed_report_latest(feed: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """DAU, views, likes and CTR of the latest day of the feed window, with the
    report's 'dd/MM/yyyy' date label (one aggregate: ``max_by`` over days)."""
    m = audience.feed_daily_metrics(feed, as_of, days)
    latest = m.agg(F.max_by(F.struct(*m.columns), "date").alias("r")).where(F.col("r").isNotNull())
    return latest.select("r.*").withColumn("report_date", F.date_format("date", REPORT_DATE_FORMAT))


def _long(one_row: DataFrame, names: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("value")) for n in names])
    return one_row.select(F.inline(pairs))


def app_report_latest(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """The twelve figures of the app report as (metric, value) rows.

    Each base table is reduced once: per-day (or per-cohort-day) sums, then
    ``max_by(value, day)`` picks the latest day's figure in the same
    aggregate, so no table is joined back to its own maximum. New users by
    source use the newest cohort day in the acquisition table; a source
    without new users that day reports 0.
    """
    return app_report_figures(
        audience.acquisition_by_source(feed, messages, as_of),
        audience.dau_segments(feed, messages, as_of, days),
        audience.app_daily_actions(feed, messages, as_of),
    )


def app_report_figures(acq: DataFrame, dau: DataFrame, acts: DataFrame) -> DataFrame:
    """The twelve figures from the acquisition, DAU-segment and daily-action tables."""
    def zsum(cond, col):
        return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0))

    acq_days = acq.groupBy("start").agg(
        F.sum("new_users").alias("users"),
        zsum(F.col("source") == "ads", "new_users").alias("ads"),
        zsum(F.col("source") == "organic", "new_users").alias("organic"),
    )
    acq_row = acq_days.agg(
        F.coalesce(F.sum("users"), F.lit(0)).alias("total_audience"),
        F.coalesce(F.max_by("ads", "start"), F.lit(0)).alias("new_ads_users"),
        F.coalesce(F.max_by("organic", "start"), F.lit(0)).alias("new_organic_users"),
    )
    dau_days = dau.groupBy("date").agg(
        F.sum("dau").alias("total"),
        zsum(F.col("app") == audience.BOTH, "dau").alias("both"),
        zsum(F.col("app") == audience.ONLY_FEED, "dau").alias("only_feed"),
        zsum(F.col("app") == audience.ONLY_MESSENGER, "dau").alias("only_messenger"),
    )
    dau_row = dau_days.agg(
        F.coalesce(F.max_by("total", "date"), F.lit(0)).alias("dau_total"),
        F.coalesce(F.max_by("both", "date"), F.lit(0)).alias("dau_feed_and_messenger"),
        F.coalesce(F.max_by("only_feed", "date"), F.lit(0)).alias("dau_only_feed"),
        F.coalesce(F.max_by("only_messenger", "date"), F.lit(0)).alias("dau_only_messenger"),
    )
    acts_row = acts.agg(  # one row per date already
        F.coalesce(F.sum("posts"), F.lit(0)).alias("total_posts"),
        F.coalesce(F.max_by("posts", "date"), F.lit(0)).alias("new_posts"),
        F.coalesce(F.max_by("views", "date"), F.lit(0)).alias("views"),
        F.coalesce(F.max_by("likes", "date"), F.lit(0)).alias("likes"),
        F.coalesce(F.max_by("messages", "date"), F.lit(0)).alias("messages"),
    )
    return (
        _long(acq_row, ["total_audience", "new_ads_users", "new_organic_users"])
        .unionByName(_long(dau_row, ["dau_total", "dau_feed_and_messenger", "dau_only_feed", "dau_only_messenger"]))
        .unionByName(_long(acts_row, ["total_posts", "new_posts", "views", "likes", "messages"]))
    )


def app_week_series(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Views, likes, posts and messages of the last ``days`` days with a 'dd MMM' label."""
    return week_series_from(audience.app_daily_actions(feed, messages, as_of), as_of, days)


def week_series_from(acts: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """The weekly series from a daily-actions table."""
    return acts.where(F.col("date") >= F.lit(as_of - timedelta(days=days))).select(
        "date", F.date_format("date", SERIES_FORMAT).alias("label"), "views", "likes", "posts", "messages",
        F.format_number("views", 0).alias("views_label"), F.format_number("likes", 0).alias("likes_label"))


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stable order (a notebook ``head()``; the limit is the feature)."""
    return df.orderBy(*order).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) of a frame as a one-row DataFrame; the count runs distributed."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
