"""Audience operators over the feed and messenger logs: daily feed KPIs, DAU
by service segment, hourly activity, posts, daily actions, first-activity
cohorts, acquisition, retention and DAU drill-downs.

All windows are explicit: ``as_of`` is "today"; the trailing window is the
``days`` full days before it. History-wide operators (first activity day,
"ever used the other service") cut the logs at the end of ``as_of`` so a run
for an old ``as_of`` backfills the same numbers it would have produced then.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions.columns import before_day_after, between_days, safe_ratio

# Segment labels of the app report's DAU table.
BOTH = "messenger and newsfeed"
ONLY_FEED = "only newsfeed"
ONLY_MESSENGER = "only messenger"


def trailing_window(as_of: date, days: int = 7) -> tuple[date, date]:
    return as_of - timedelta(days=days), as_of - timedelta(days=1)


def _in_window(log: DataFrame, as_of: date, days: int) -> DataFrame:
    first, last = trailing_window(as_of, days)
    return log.where(between_days("time", first, last))


def _history(log: DataFrame, as_of: date) -> DataFrame:
    return log.where(before_day_after("time", as_of))


def feed_daily_metrics(feed: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Per day of the trailing window: DAU, views, likes and CTR in percent.

    CTR is rounded half-to-even to one decimal; NULL on a day without views.
    """
    return (
        _in_window(feed, as_of, days)
        .groupBy(F.to_date("time").alias("date"))
        .agg(
            F.count_distinct("user_id").alias("dau"),
            F.count_if(F.col("action") == "view").alias("views"),
            F.count_if(F.col("action") == "like").alias("likes"),
        )
        .withColumn("ctr", F.bround(safe_ratio(F.col("likes") * 100, "views"), 1))
    )


def feed_history_metrics(feed: DataFrame, as_of: date) -> DataFrame:
    """Daily feed KPIs over the whole history before ``as_of`` (the history dashboard)."""
    return (
        feed.where(F.col("time") < F.lit(as_of).cast("timestamp_ntz"))
        .groupBy(F.to_date("time").alias("date"))
        .agg(
            F.count_distinct("user_id").alias("dau"),
            F.count_if(F.col("action") == "view").alias("views"),
            F.count_if(F.col("action") == "like").alias("likes"),
        )
        .withColumn("ctr", F.bround(safe_ratio(F.col("likes") * 100, "views"), 1))
    )


def activity_history_by_hour(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """Actions per day and hour over the whole history before ``as_of``."""
    cols = [F.to_date("time").alias("day"), F.hour("time").alias("hour"), "user_id"]
    cut = F.col("time") < F.lit(as_of).cast("timestamp_ntz")
    both = feed.where(cut).select(cols).unionByName(messages.where(cut).select(cols))
    return both.groupBy("day", "hour").agg(F.count("user_id").alias("actions"))


def _user_days(log: DataFrame, as_of: date, days: int) -> DataFrame:
    return _in_window(log, as_of, days).select(F.to_date("time").alias("date"), "user_id").distinct()


def _ever_users(log: DataFrame, as_of: date) -> DataFrame:
    return _history(log, as_of).select("user_id").distinct()


def dau_both_services(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Users active in the feed on a day who also messaged on *any* day of the window.

    This is the reference's literal query (the two sides are joined on the
    user only and the feed date is kept). The right side reduces to the
    distinct messaging users, so the join is a semi join that never
    multiplies rows.
    """
    feed_days = _user_days(feed, as_of, days)
    msg_users = _in_window(messages, as_of, days).select("user_id").distinct()
    return (
        feed_days.join(msg_users, "user_id", "left_semi")
        .groupBy("date")
        .agg(F.count("user_id").alias("dau"))
        .select("date", F.lit(BOTH).alias("app"), "dau")
    )


def dau_both_same_day(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Users who used both services on the same day (the stated intent)."""
    both = _user_days(feed, as_of, days).join(_user_days(messages, as_of, days), ["date", "user_id"], "left_semi")
    return both.groupBy("date").agg(F.count("user_id").alias("dau")).select("date", F.lit(BOTH).alias("app"), "dau")


def dau_only_feed(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Feed DAU of users who never messaged (over the whole history up to as_of).

    Expressed as an anti join on distinct ids rather than ``NOT IN``: Spark
    plans ``NOT IN`` as a null-aware broadcast-only join, while a left anti
    join can sort-merge when the id set is large.
    """
    days_ = _user_days(feed, as_of, days).join(_ever_users(messages, as_of), "user_id", "left_anti")
    return days_.groupBy("date").agg(F.count("user_id").alias("dau")).select(
        "date", F.lit(ONLY_FEED).alias("app"), "dau")


def dau_only_messenger(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Messenger DAU of users who never used the feed, densified to every
    messenger-active day of the window (0 where none)."""
    only = (
        _user_days(messages, as_of, days)
        .join(_ever_users(feed, as_of), "user_id", "left_anti")
        .groupBy("date")
        .agg(F.count("user_id").alias("dau"))
    )
    active_days = _in_window(messages, as_of, days).select(F.to_date("time").alias("date")).distinct()
    return only.join(active_days, "date", "full_outer").select(
        "date", F.lit(ONLY_MESSENGER).alias("app"), F.coalesce("dau", F.lit(0)).cast("bigint").alias("dau"))


def dau_segments(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """The three DAU segments of the app report, stacked, from one pass over the logs.

    A user reduces to whether they ever used each service and their active
    days in the window (at most ``days`` a service, combined before the
    shuffle); the segments' rows follow from that one row.
    """
    first, last = trailing_window(as_of, days)

    def one(log, service):
        return _history(log, as_of).where(F.col("user_id").isNotNull()).select(
            "user_id", F.lit(service).alias("service"), F.to_date("time").alias("date"))

    inside = F.col("date").between(F.lit(first), F.lit(last))
    in_feed = F.col("service") == "feed"
    users = one(feed, "feed").unionByName(one(messages, "messenger")).groupBy("user_id").agg(
        F.max(in_feed).alias("fed"), F.max(~in_feed).alias("messaged"),
        F.collect_set(F.when(inside & in_feed, F.col("date"))).alias("feed_days"),
        F.collect_set(F.when(inside & ~in_feed, F.col("date"))).alias("message_days"))

    def rows(days_, app, n):
        return F.transform(days_, lambda x: F.struct(x.alias("date"), F.lit(app).alias("app"), n.alias("n")))

    one_, none = F.lit(1), F.array().cast("array<date>")
    pieces = F.concat(
        rows(F.when(F.size("message_days") > 0, F.col("feed_days")).otherwise(none), BOTH, one_),
        rows(F.when(~F.col("messaged"), F.col("feed_days")).otherwise(none), ONLY_FEED, one_),
        rows(F.col("message_days"), ONLY_MESSENGER, F.when(F.col("fed"), 0).otherwise(1)))
    return users.select(F.inline(pieces)).groupBy("date", "app").agg(F.sum("n").alias("dau"))


def activity_by_hour(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Actions (feed actions + messages) per day and hour of the trailing window."""
    cols = [F.to_date("time").alias("day"), F.hour("time").alias("hour"), "user_id"]
    both = _in_window(feed, as_of, days).select(cols).unionByName(_in_window(messages, as_of, days).select(cols))
    return both.groupBy("day", "hour").agg(F.count("user_id").alias("actions"))


def new_posts_daily(feed: DataFrame, as_of: date) -> DataFrame:
    """Posts by the day they were first seen (before ``as_of``)."""
    first_seen = (
        _history(feed, as_of)
        .groupBy("post_id")
        .agg(F.min(F.to_date("time")).alias("date"))
    )
    return first_seen.groupBy("date").agg(F.count("post_id").alias("posts")).where(F.col("date") < F.lit(as_of))


def app_daily_actions(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """Messages, likes, views and new posts per day over the whole history, today excluded.

    Full outer joins on a coalesced date (the reference's chained join loses
    the date of a day missing from the first table; here it is kept).
    """
    msgs = _history(messages, as_of).groupBy(F.to_date("time").alias("date")).agg(
        F.count("user_id").alias("messages"))
    acts = _history(feed, as_of).groupBy(F.to_date("time").alias("date")).agg(
        F.count_if(F.col("action") == "like").alias("likes"),
        F.count_if(F.col("action") == "view").alias("views"),
    )
    posts = new_posts_daily(feed, as_of)
    out = msgs.join(acts, "date", "full_outer").join(posts, "date", "full_outer")
    return out.where(F.col("date") < F.lit(as_of)).select(
        "date",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("messages", "likes", "views", "posts")],
    )


# ---------------------------------------------------------------- cohorts
def activity_days(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """Distinct (user_id, action day, source) over both services up to as_of.

    The distinct is a hash aggregate with a map-side partial step, so a user
    with a huge number of events still contributes at most one row per (day,
    source) to the shuffle.
    """
    cols = ["user_id", F.to_date("time").alias("action"), "source"]
    return (
        _history(messages, as_of).select(cols)
        .unionByName(_history(feed, as_of).select(cols))
        .distinct()
    )


def with_first_day(days_: DataFrame) -> DataFrame:
    """Adds ``start`` = the user's first action day over all sources.

    A window partitioned by user: after the distinct above each user has at
    most (days x sources) rows, so no partition holds an unbounded group.
    """
    return days_.withColumn("start", F.min("action").over(Window.partitionBy("user_id")))


def retention_cohorts(feed: DataFrame, messages: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Active users per (action day, cohort start, source) for cohorts started in the last ``days`` days.

    A user seen with two sources counts once per source (as in the reference).
    """
    cohort = with_first_day(activity_days(feed, messages, as_of))
    return (
        cohort.groupBy("action", "start", "source")
        .agg(F.count("user_id").alias("users"))
        .where(F.col("start") >= F.lit(as_of - timedelta(days=days)))
    )


def acquisition_by_source(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """New users per (first day, source), today excluded."""
    cohort = with_first_day(activity_days(feed, messages, as_of))
    return (
        cohort.select("user_id", "start", "source").distinct()
        .groupBy("start", "source")
        .agg(F.count("user_id").alias("new_users"))
        .where(F.col("start") != F.lit(as_of))
    )


def retention_rate_by_source(feed: DataFrame, messages: DataFrame, as_of: date, cohorts: int = 20) -> DataFrame:
    """Retention rate per (cohort start, source, action day) for the last ``cohorts`` cohorts.

    rate = users active on the day / users of the cohort active on its start
    day (same source). Users with two sources can make a rate exceed 1, a
    consequence of counting per source.
    """
    first = as_of - timedelta(days=cohorts)
    counts = (
        with_first_day(activity_days(feed, messages, as_of))
        .where((F.col("start") >= F.lit(first)) & (F.col("start") < F.lit(as_of)))
        .groupBy("start", "source", "action")
        .agg(F.count("user_id").alias("users"))
    )
    return retention_rate_from_counts(counts)


def retention_rate_from_counts(counts: DataFrame) -> DataFrame:
    """Rates from (start, source, action, users) cohort counts."""
    sizes = counts.where(F.col("action") == F.col("start")).select(
        "start", "source", F.col("users").alias("cohort_size"))
    return counts.join(sizes, ["start", "source"], "left").select(
        "start", "source", "action",
        F.datediff("action", "start").alias("day_number"),
        "users",
        F.coalesce("cohort_size", F.lit(0)).cast("bigint").alias("cohort_size"),
        safe_ratio("users", "cohort_size").alias("retention_rate"),
    )


def cohort_dau(feed: DataFrame, messages: DataFrame, as_of: date, source: str,
               start_from: date, start_to: date, feed_only: bool = False) -> DataFrame:
    """Daily active users of one acquisition cohort: users whose first day (over
    both services) is in [start_from, start_to], counted on each day they are
    active through ``source`` - in either service, or in the feed only."""
    cohort = with_first_day(activity_days(feed, messages, as_of)).where(
        (F.col("source") == source) & F.col("start").between(F.lit(start_from), F.lit(start_to)))
    if feed_only:
        active = _history(feed, as_of).where(F.col("source") == source).select(
            "user_id", F.to_date("time").alias("action")).distinct()
        cohort = active.join(cohort.select("user_id").distinct(), "user_id", "left_semi")
    return cohort.groupBy(F.col("action").alias("date")).agg(F.count_distinct("user_id").alias("dau"))


def dau_change_by(feed: DataFrame, as_of: date, dimension: str = "city", first: date | None = None) -> DataFrame:
    """Feed DAU per (day, dimension value) against the previous day, from one scan.

    Every daily count enters its own day and, as the previous figure, the day
    after, so values that vanished keep a row (DAU 0). ``first`` restricts the
    report to days from it on; the scan then starts the day before.
    """
    log = _history(feed, as_of)
    if first is not None:
        log = log.where(F.col("time") >= F.lit(first - timedelta(days=1)).cast("timestamp_ntz"))
    daily = log.groupBy(F.to_date("time").alias("day"), F.col(dimension)).agg(F.count_distinct("user_id").alias("n"))
    zero = F.lit(0).cast("bigint")
    sides = F.array(F.struct(F.col("day").alias("date"), F.col("n").alias("dau"), zero.alias("prev_dau")),
                    F.struct(F.date_add("day", 1).alias("date"), zero.alias("dau"), F.col("n").alias("prev_dau")))
    out = daily.select(dimension, F.inline(sides)).groupBy("date", dimension).agg(
        F.sum("dau").alias("dau"), F.sum("prev_dau").alias("prev_dau")).where(F.col("date") < F.lit(as_of))
    if first is not None:
        out = out.where(F.col("date") >= F.lit(first))
    delta = F.col("dau") - F.col("prev_dau")
    return out.select("date", dimension, "dau", "prev_dau", delta.alias("delta"),
                      F.try_divide(delta * 100.0, F.col("prev_dau").cast("double")).alias("pct_change"))
