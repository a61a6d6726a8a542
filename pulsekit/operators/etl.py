"""Daily ETL: per-user feed and messenger metrics, their merge, and the
long-form metrics mart sliced by os, gender and age bin.

The mart does not need the per-user merge: every mart figure is a sum over
rows grouped by values (day, os, gender, age) that both sides of the merge
share, so summing the union of the feed and messenger rows equals summing
the merged rows. Feed views and likes are plain counts, so raw feed rows go
straight into the slice aggregate (map-side combine; the feed is never
shuffled per user). Only the messenger side is aggregated per user, because
distinct receivers/senders and the received-side join (users who only
receive are dropped, a two-OS sender counts received messages per OS row)
are per-user semantics. Plan: two pruned one-day scans -> per-user
messenger aggregates and their join -> union with feed rows -> one
partial/final aggregate per (day, os, gender, age) -> fan-out of those cells
to the three slices -> a small second aggregate.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import age_bin, gender_label, on_day
from pulsekit.sources.schemas import MART_METRICS

USER_KEYS = ["user_id", "event_date", "os", "gender", "age"]
MESSAGE_METRICS = ["users_sent", "messages_sent", "users_received", "messages_received"]
DIMENSIONS = ("os", "gender", "age")


def etl_day(as_of: date) -> date:
    """The ETL loads "yesterday" relative to ``as_of``."""
    return as_of - timedelta(days=1)


def feed_user_daily(feed: DataFrame, as_of: date) -> DataFrame:
    """Likes and views per (user, day, os, gender label, age) for the ETL day."""
    day = etl_day(as_of)
    return (
        feed.where(on_day("time", day))
        .select(
            "user_id",
            F.to_date("time").alias("event_date"),
            "os",
            gender_label("gender").alias("gender"),
            "age",
            "action",
        )
        .groupBy(*USER_KEYS)
        .agg(
            F.count_if(F.col("action") == "like").alias("likes"),
            F.count_if(F.col("action") == "view").alias("views"),
        )
    )


def messages_sent_daily(messages: DataFrame, as_of: date) -> DataFrame:
    """Per sender: distinct receivers and messages, keyed like the feed side."""
    day = etl_day(as_of)
    return (
        messages.where(on_day("time", day))
        .select(
            "user_id",
            F.to_date("time").alias("event_date"),
            "os",
            gender_label("gender").alias("gender"),
            "age",
            "reciever_id",
            "time",
        )
        .groupBy(*USER_KEYS)
        .agg(
            F.count_distinct("reciever_id").alias("users_sent"),
            F.count("time").alias("messages_sent"),
        )
    )


def messages_received_daily(messages: DataFrame, as_of: date) -> DataFrame:
    """Per receiver: distinct senders and messages received that day."""
    day = etl_day(as_of)
    return (
        messages.where(on_day("time", day))
        .groupBy(F.col("reciever_id").alias("user_id"))
        .agg(
            F.count_distinct("user_id").alias("users_received"),
            F.count("time").alias("messages_received"),
        )
    )


def message_user_daily(messages: DataFrame, as_of: date) -> DataFrame:
    """Sent-side rows with the received side joined on the user.

    A left join from the sent side, as in the reference: users who only
    receive are not in the result, and a sender seen with two OS values gets
    the received figures on both rows.
    """
    sent = messages_sent_daily(messages, as_of)
    received = messages_received_daily(messages, as_of)
    return sent.join(received, "user_id", "left").select(
        *USER_KEYS,
        "users_sent",
        "messages_sent",
        F.coalesce("users_received", F.lit(0)).alias("users_received"),
        F.coalesce("messages_received", F.lit(0)).alias("messages_received"),
    )


def user_daily_merged(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """Full outer merge of the feed and messenger per-user rows on the five keys.

    Keys are compared null-safely (a null age or os on both sides still
    matches, as in a pandas merge); missing metrics become 0.
    """
    f = feed_user_daily(feed, as_of).alias("f")
    m = message_user_daily(messages, as_of).alias("m")
    cond = None
    for k in USER_KEYS:
        c = F.col(f"f.{k}").eqNullSafe(F.col(f"m.{k}"))
        cond = c if cond is None else cond & c
    keys = [F.coalesce(F.col(f"f.{k}"), F.col(f"m.{k}")).alias(k) for k in USER_KEYS]
    metrics = [F.coalesce(F.col(f"f.{c}"), F.lit(0)).alias(c) for c in ("likes", "views")] + [
        F.coalesce(F.col(f"m.{c}"), F.lit(0)).alias(c) for c in MESSAGE_METRICS
    ]
    return f.join(m, cond, "full_outer").select(*keys, *metrics)


def _dimension_value(dim: str):
    if dim == "age":
        return age_bin("age")
    return F.col(dim).cast("string")


def metrics_by_dimensions(merged: DataFrame, dimensions=DIMENSIONS) -> DataFrame:
    """Long-form mart rows for several slice dimensions in one aggregation.

    Rows are summed per (day, os, gender, age) first; the few cells are then
    fanned out once per dimension as (dimension, dimension_value). Null slice values are dropped (a pandas groupby drops
    null keys); the six metrics are summed by name.
    """
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dimension"), _dimension_value(d).alias("dimension_value"))
        for d in dimensions
    ])
    cells = merged.groupBy("event_date", "os", "gender", "age").agg(*[F.sum(m).alias(m) for m in MART_METRICS])
    fanned = cells.select(
        "event_date", F.inline(pairs), *[F.col(m) for m in MART_METRICS]
    ).where(F.col("dimension_value").isNotNull())
    return fanned.groupBy("event_date", "dimension", "dimension_value").agg(
        *[F.sum(m).cast("bigint").alias(m) for m in MART_METRICS]
    )


def mart_rows(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """Rows whose sums per (day, os, gender, age) equal those of the merged per-user frame.

    Feed rows are raw actions (one view or like each); messenger rows are the
    per-user sent/received aggregates.
    """
    day = etl_day(as_of)
    zero = F.lit(0).cast("bigint")
    feed_rows = feed.where(on_day("time", day)).select(
        F.to_date("time").alias("event_date"), "os", gender_label("gender").alias("gender"), "age",
        (F.col("action") == "view").cast("bigint").alias("views"),
        (F.col("action") == "like").cast("bigint").alias("likes"),
        *[zero.alias(c) for c in MESSAGE_METRICS],
    )
    msg_rows = message_user_daily(messages, as_of).select(
        "event_date", "os", "gender", "age", zero.alias("views"), zero.alias("likes"), *MESSAGE_METRICS)
    return feed_rows.unionByName(msg_rows)


def slice_metrics(feed: DataFrame, messages: DataFrame, as_of: date, dimension: str) -> DataFrame:
    """One slice of the mart (dimension in 'os', 'gender', 'age')."""
    return metrics_by_dimensions(mart_rows(feed, messages, as_of), (dimension,))


def metrics_mart(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """The daily metrics mart for ``as_of - 1`` with all three slices."""
    return metrics_by_dimensions(mart_rows(feed, messages, as_of))
