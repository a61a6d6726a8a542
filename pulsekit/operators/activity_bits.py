"""Per-user activity bitsets: cohorts, cohort DAU and cross-service audience without rereading logs.

State: one row per (user, source, service, block of 56 days) whose ``bits`` has
bit i set when the user was active on day ``56 * block + i`` (days since
1970-01-01). A daily load reads one day of logs, sets that day's bits (OR: a
repeated day changes nothing, a late day lands where it belongs) and puts the
new version of the touched blocks into force through the manifest, so readers
never see half a load. 56 days fit a positive long; the first active day of a
block is its lowest set bit, ``bit_count((bits & -bits) - 1)``.

The ``*_from_bits`` operators give the same rows as the full recomputations in
``audience`` and read nothing but the state. Every step groups by user first and
a user has at most sources x services rows a block, so no key is hot. Rows
without a user are left out, as the counts of users are.
"""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions.columns import between_days
from pulsekit.operators import audience
from pulsekit.sources.manifest import list_names, publish, read_manifest

FEED, MESSENGER = "feed", "messenger"
BLOCK_DAYS = 56
KEYS = ["user_id", "source", "service", "block"]
SCHEMA = "user_id long, source string, service string, bits long, block int"


def _day_number(d: date) -> int:
    return (d - date(1970, 1, 1)).days


def _block(d: date) -> int:
    return _day_number(d) // BLOCK_DAYS


def day_bits(feed: DataFrame, messages: DataFrame, first: date, last: date) -> DataFrame:
    """State rows of the days first..last (bits are combined map-side)."""
    def one(log, service):
        return log.where(between_days("time", first, last) & F.col("user_id").isNotNull()).select(
            "user_id", "source", F.lit(service).alias("service"), F.unix_date(F.to_date("time")).alias("_d"))

    day = F.col("_d")
    bit = F.expr(f"shiftleft(1L, pmod(_d, {BLOCK_DAYS}))")
    return (
        one(feed, FEED).unionByName(one(messages, MESSENGER))
        .groupBy("user_id", "source", "service", F.floor(day / BLOCK_DAYS).cast("int").alias("block"))
        .agg(F.bit_or(bit).alias("bits")).select(*KEYS, "bits")
    )


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy(*KEYS).agg(F.bit_or("bits").alias("bits"))


def read_activity(spark: SparkSession, root: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The state in force; only folders of blocks that meet first..last are read."""
    low, high = (None if d is None else _block(d) for d in (first, last))
    folders = [f"{root}/{at}" for b, at in sorted(read_manifest(spark, root).items())
               if (low is None or int(b) >= low) and (high is None or int(b) <= high)]
    if not folders:
        return spark.createDataFrame([], SCHEMA).select(*KEYS, "bits")
    return spark.read.schema(SCHEMA).option("basePath", f"{root}/data").parquet(*folders).select(*KEYS, "bits")


def load_activity(spark: SparkSession, root: str, feed: DataFrame, messages: DataFrame, first: date,
                  last: date | None = None) -> None:
    """Fold the days first..last (default: one day; a backfill: all of history) into the state under ``root``."""
    last = last or first
    load = f"data/load={uuid.uuid4().hex}"
    held = read_activity(spark, root, first, last)
    merged(held, day_bits(feed, messages, first, last)).write.partitionBy("block").parquet(f"{root}/{load}")
    blocks = [n for n in list_names(spark, f"{root}/{load}") if n.startswith("block=")]
    if blocks:
        publish(spark, root, {n.partition("=")[2]: f"{load}/{n}" for n in blocks})


# ---------------------------------------------------------------- reading the state
def _upto(state: DataFrame, as_of: date) -> DataFrame:
    """The state without activity after ``as_of``."""
    day = _day_number(as_of)
    keep = (1 << (day % BLOCK_DAYS + 1)) - 1
    bits = F.when(F.col("block") == day // BLOCK_DAYS, F.col("bits").bitwiseAND(F.lit(keep))).otherwise(F.col("bits"))
    return state.where(F.col("block") <= day // BLOCK_DAYS).withColumn("bits", bits).where("bits != 0")


def _start() -> Column:
    """The user's first active day, as an aggregate."""
    return F.date_from_unix_date(F.min(F.expr(f"block * {BLOCK_DAYS} + bit_count((bits & -bits) - 1)").cast("int")))


def cohort_activity(state: DataFrame, as_of: date, first: date, last: date, service: str | None = None) -> DataFrame:
    """Distinct (user_id, start, source, action) up to ``as_of`` of users whose first active day, over all sources
    and services, is in first..last; ``service`` restricts the actions."""
    row = F.struct("source", "service", "block", "bits")
    users = (
        _upto(state, as_of).groupBy("user_id")
        # whoever starts in first..last has no bits before; earlier blocks only tell that others do
        .agg(_start().alias("start"), F.collect_list(F.when(F.col("block") >= _block(first), row)).alias("rows"))
        .where(F.col("start").between(F.lit(first), F.lit(last)))
        .select("user_id", "start", F.inline("rows"))
    )
    if service is not None:
        users = users.where(F.col("service") == service)
    days = F.filter(F.sequence(F.lit(0), F.lit(BLOCK_DAYS - 1)), lambda i: F.getbit("bits", i) == 1)
    return (
        users.groupBy("user_id", "start", "source", "block").agg(F.bit_or("bits").alias("bits"))
        .select("user_id", "start", "source", "block", F.explode(days).alias("i"))
        .select("user_id", "start", "source",
                F.date_from_unix_date((F.col("block") * BLOCK_DAYS + F.col("i")).cast("int")).alias("action"))
    )


def retention_from_bits(state: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Same rows as ``audience.retention_cohorts``."""
    return cohort_activity(state, as_of, as_of - timedelta(days=days), as_of).groupBy("action", "start", "source").agg(
        F.count("user_id").alias("users"))


def retention_rate_from_bits(state: DataFrame, as_of: date, cohorts: int = 20) -> DataFrame:
    """Same rows as ``audience.retention_rate_by_source``."""
    acts = cohort_activity(state, as_of, as_of - timedelta(days=cohorts), as_of - timedelta(days=1))
    return audience.retention_rate_from_counts(
        acts.groupBy("start", "source", "action").agg(F.count("user_id").alias("users")))


def acquisition_from_bits(state: DataFrame, as_of: date) -> DataFrame:
    """Same rows as ``audience.acquisition_by_source``."""
    users = _upto(state, as_of).groupBy("user_id").agg(
        _start().alias("start"), F.collect_set(F.struct("source")).alias("sources"))
    return (
        users.where(F.col("start") != F.lit(as_of)).select("start", F.inline("sources"))
        .groupBy("start", "source").agg(F.count(F.lit(1)).alias("new_users"))
    )


def cohort_dau_from_bits(state: DataFrame, as_of: date, source: str, start_from: date, start_to: date,
                         feed_only: bool = False) -> DataFrame:
    """Same rows as ``audience.cohort_dau``."""
    acts = cohort_activity(state, as_of, start_from, start_to, FEED if feed_only else None)
    return acts.where(F.col("source") == source).groupBy(F.col("action").alias("date")).agg(
        F.count("user_id").alias("dau"))


def _window_users(state: DataFrame, as_of: date, days: int) -> DataFrame:
    """One row per user: fed and messaged (ever), and the window's days of each service as bits (bit 0 = its first day)."""
    if not 0 < days <= BLOCK_DAYS:
        raise ValueError(f"a window has 1 to {BLOCK_DAYS} days")
    first = _day_number(as_of) - days
    inside = (1 << days) - 1
    shifted = F.lit(0).cast("long")
    for block in range(first // BLOCK_DAYS, (first + days - 1) // BLOCK_DAYS + 1):  # one or two
        by = first - block * BLOCK_DAYS
        moved = F.shiftright("bits", by) if by >= 0 else F.shiftleft(
            F.col("bits").bitwiseAND(F.lit((1 << (days + by)) - 1)), -by)
        shifted = F.when(F.col("block") == block, moved.bitwiseAND(F.lit(inside))).otherwise(shifted)
    in_feed = F.col("service") == FEED
    return _upto(state, as_of).groupBy("user_id").agg(
        F.max(in_feed).alias("fed"), F.max(~in_feed).alias("messaged"),
        F.bit_or(F.when(in_feed, shifted).otherwise(0)).alias("feed_days"),
        F.bit_or(F.when(~in_feed, shifted).otherwise(0)).alias("message_days"))


def dau_segments_from_bits(state: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Same rows as ``audience.dau_segments``."""
    first = as_of - timedelta(days=days)

    def rows(bits, app, n):
        set_days = F.filter(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.getbit(bits, i) == 1)
        return F.transform(set_days, lambda i: F.struct(
            F.date_add(F.lit(first), i).alias("date"), F.lit(app).alias("app"), n.alias("n")))

    none, one = F.lit(0).cast("long"), F.lit(1)
    pieces = F.concat(
        rows(F.when(F.col("message_days") != 0, F.col("feed_days")).otherwise(none), audience.BOTH, one),
        rows(F.when(~F.col("messaged"), F.col("feed_days")).otherwise(none), audience.ONLY_FEED, one),
        rows(F.col("message_days"), audience.ONLY_MESSENGER, F.when(F.col("fed"), 0).otherwise(1)))
    return _window_users(state, as_of, days).select(F.inline(pieces)).groupBy("date", "app").agg(F.sum("n").alias("dau"))


def dau_both_same_day_from_bits(state: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Same rows as ``audience.dau_both_same_day``: the days of both services are one AND."""
    first = as_of - timedelta(days=days)
    both = F.col("feed_days").bitwiseAND(F.col("message_days"))
    set_days = F.filter(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.getbit("both", i) == 1)
    return (
        _window_users(state, as_of, days).select(both.alias("both")).where("both != 0")
        .select(F.explode(set_days).alias("i")).groupBy(F.date_add(F.lit(first), F.col("i")).alias("date"))
        .agg(F.count(F.lit(1)).alias("dau")).select("date", F.lit(audience.BOTH).alias("app"), "dau")
    )
