"""DAU change along every dimension at once, from bitmaps of dense user ids.

Users get dense ids 0..n-1 (no group is sorted in one task). One scan of the log
gives the distinct (day, user, dimension values); each row sets one bit in the
bitmap of every (day, dimension, value), 32,768 users a bitmap, combined
map-side. Bit counts are exact distinct counts, and a dimension more costs bits,
not another distinct over the log.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import age_bin, before_day_after, gender_label
from pulsekit.operators.resampling import dense_index

TOTAL = "total"


def default_dimensions() -> dict[str, Column]:
    return {"os": F.col("os"), "gender": gender_label(), "age": age_bin(), "source": F.col("source"), "city": F.col("city")}


def daily_user_bitmaps(log: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """(day, dimension, value, bucket, users): bitmaps of the users seen, 32,768 dense ids a bucket;
    dimension 'total' has the single value 'all'. Bitmaps of several days can be merged with ``bitmap_or_agg``."""
    facts = log.where(F.col("user_id").isNotNull()).select(
        F.to_date("time").alias("day"), "user_id",
        *[c.cast("string").alias(f"d{i}") for i, c in enumerate(dimensions.values())]).distinct()
    users = facts.select("user_id").distinct().withColumn("_all", F.lit(0))
    ids = dense_index(users, "_all").select("user_id", F.col("idx").cast("long").alias("uid"))
    values = F.array(F.struct(F.lit(TOTAL).alias("dimension"), F.lit("all").alias("value")),
                     *[F.struct(F.lit(name).alias("dimension"), F.col(f"d{i}").alias("value"))
                       for i, name in enumerate(dimensions)])
    return (
        facts.join(ids, "user_id").select("day", "uid", F.inline(values))
        .groupBy("day", "dimension", "value", F.bitmap_bucket_number("uid").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("uid")).alias("users"))
    )


def dau_change_by_dimensions(feed: DataFrame, as_of: date, dimensions: dict[str, Column] | None = None,
                             first: date | None = None) -> DataFrame:
    """Feed DAU per (day, dimension, value) against the previous day, before ``as_of``.

    ``delta_share`` is the value's part of the change of the whole DAU that day
    (NULL when that did not change); values of a dimension may add up to other than
    1, since a user can be seen with two of them. Days and values without users on
    one of two neighbouring days count 0 there, as in ``audience.dau_change_by``.
    ``first`` restricts the report to days from it on; the scan starts the day before.
    """
    log = feed.where(before_day_after("time", as_of))
    if first is not None:
        log = log.where(F.col("time") >= F.lit(first - timedelta(days=1)).cast("timestamp_ntz"))
    daily = (
        daily_user_bitmaps(log, default_dimensions() if dimensions is None else dimensions)
        .groupBy("day", "dimension", "value").agg(F.sum(F.bitmap_count("users")).alias("n"))
    )
    zero = F.lit(0).cast("bigint")
    sides = F.array(F.struct(F.col("day").alias("date"), F.col("n").alias("dau"), zero.alias("prev_dau")),
                    F.struct(F.date_add("day", 1).alias("date"), zero.alias("dau"), F.col("n").alias("prev_dau")))
    out = daily.select("dimension", "value", F.inline(sides)).groupBy("date", "dimension", "value").agg(
        F.sum("dau").alias("dau"), F.sum("prev_dau").alias("prev_dau")).where(F.col("date") < F.lit(as_of))
    if first is not None:
        out = out.where(F.col("date") >= F.lit(first))
    delta = F.col("dau") - F.col("prev_dau")
    # the whole change of a day, one row a day: bounded by the days of the report
    whole = out.where(F.col("dimension") == TOTAL).select("date", delta.alias("total_delta"))
    return out.join(F.broadcast(whole), "date", "left").select(
        "date", "dimension", "value", "dau", "prev_dau", delta.alias("delta"),
        F.try_divide(delta * 100.0, F.col("prev_dau").cast("double")).alias("pct_change"),
        F.try_divide(delta.cast("double"), F.col("total_delta").cast("double")).alias("delta_share"))
