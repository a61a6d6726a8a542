"""Cross-service audience over any window from mergeable theta sketches.

One sketch of users per (day, service) is all that is kept: at most 2^lg_k
hashes each, whatever the traffic. Windows and histories are unions of days,
"both services" is an intersection and "only one" a difference of sketches, so
a figure over any period costs as many sketches as it has days, and no log is read.

A sketch of at most 2^lg_k users is exact. Beyond, a set of n users out of a
union of N has a standard error of about sqrt(n * N / 2^lg_k); ``margin`` is three of
them, with the sketches' own estimates for n and N. Where exact figures are
needed, use ``activity_bits``.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import between_days
from pulsekit.operators import audience
from pulsekit.operators.activity_bits import FEED, MESSENGER

LG_K = 14
BOTH_SAME_DAY = "both on the same day"


def daily_sketches(feed: DataFrame, messages: DataFrame, first: date, last: date, lg_k: int = LG_K) -> DataFrame:
    """(date, service, users): a theta sketch of the users of each day and service."""
    def one(log, service):
        return log.where(between_days("time", first, last) & F.col("user_id").isNotNull()).select(
            F.to_date("time").alias("date"), F.lit(service).alias("service"), "user_id")

    return one(feed, FEED).unionByName(one(messages, MESSENGER)).groupBy("date", "service").agg(
        F.theta_sketch_agg("user_id", F.lit(lg_k)).alias("users"))


def _estimate(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch)


def overlap(a: Column, b: Column, lg_k: int = LG_K) -> dict[str, Column]:
    """Estimates for two sketches: both, only_a, only_b, either, each with its margin."""
    union = F.theta_union(a, b, F.lit(lg_k))
    out = {"either": _estimate(union), "both": _estimate(F.theta_intersection(a, b)),
           "only_a": _estimate(F.theta_difference(a, b)), "only_b": _estimate(F.theta_difference(b, a))}
    large = F.greatest(out["either"], _estimate(a), _estimate(b))
    margins = {f"{name}_margin": F.when(large > (1 << lg_k), 3 * F.sqrt(n * large / (1 << lg_k))).otherwise(0.0)
               for name, n in out.items()}
    return out | margins


def segments_from_sketches(sketches: DataFrame, as_of: date, days: int = 7, lg_k: int = LG_K) -> DataFrame:
    """The DAU segments of ``audience.dau_segments`` and the same-day overlap: date, app, dau, margin."""
    first, last = audience.trailing_window(as_of, days)
    known = sketches.where(F.col("date") <= F.lit(as_of))
    inside = F.col("date").between(F.lit(first), F.lit(last))

    def union_of(service, where=None):
        hit = F.col("service") == service
        return F.theta_union_agg(F.when(hit if where is None else hit & where, F.col("users")), F.lit(lg_k))

    # one row: three unions over the days
    ever = known.agg(union_of(FEED).alias("ever_feed"), union_of(MESSENGER).alias("ever_msg"),
                     union_of(MESSENGER, inside).alias("window_msg"), F.lit(1).alias("_one"))
    per_day = known.where(inside).groupBy("date").agg(
        F.max(F.when(F.col("service") == FEED, F.col("users"))).alias("feed"),
        F.max(F.when(F.col("service") == MESSENGER, F.col("users"))).alias("msg")).withColumn("_one", F.lit(1))
    x = per_day.join(F.broadcast(ever), "_one")
    cases = [(audience.BOTH, "feed", "window_msg", "both"), (audience.ONLY_FEED, "feed", "ever_msg", "only_a"),
             (audience.ONLY_MESSENGER, "msg", "ever_feed", "only_a"), (BOTH_SAME_DAY, "feed", "msg", "both")]
    # a missing side is an empty set: nothing in common, all on one side
    def cell(app, a, b, what):
        figures = overlap(F.col(a), F.col(b), lg_k)
        alone = _estimate(F.col(a)) if what == "only_a" else F.lit(0).cast("long")
        n = F.when(F.col(b).isNull(), alone).otherwise(figures[what])
        margin = F.when(F.col(b).isNull(), F.lit(0.0)).otherwise(figures[f"{what}_margin"])
        # as in the exact segments, a day without anybody is a row of some segments only
        shown = F.col(a).isNotNull() & ((n > 0) | F.lit(app in (audience.ONLY_MESSENGER, BOTH_SAME_DAY)))
        return F.when(shown, F.struct(F.lit(app).alias("app"), n.cast("long").alias("dau"),
                                                      margin.cast("double").alias("margin")))

    cells = F.array_compact(F.array(*[cell(*c) for c in cases]))
    return x.select("date", F.inline(cells))


def window_overlap(sketches: DataFrame, first: date, last: date, lg_k: int = LG_K) -> DataFrame:
    """One row for the days first..last: feed and messenger users, both, only one of them, with margins."""
    window = sketches.where(F.col("date").between(F.lit(first), F.lit(last)))
    sides = window.agg(*[
        F.theta_union_agg(F.when(F.col("service") == s, F.col("users")), F.lit(lg_k)).alias(s) for s in (FEED, MESSENGER)])
    figures = overlap(F.col(FEED), F.col(MESSENGER), lg_k)
    names = {"only_a": "only_feed", "only_b": "only_messenger"}
    return sides.select(*[
        c.alias(names.get(n.replace("_margin", ""), n.replace("_margin", "")) + ("_margin" if n.endswith("_margin") else ""))
        for n, c in figures.items()])
