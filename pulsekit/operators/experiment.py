"""Experiment facts: per-user CTR, group CTR, smoothing, linearization,
hash buckets, descriptive statistics and the CTR split drill-down.

Per-user metrics are one aggregate over the pruned, window-filtered feed
scan; everything downstream works on that (much smaller) frame. Group-level
constants (group CTR, control CTR) are joined back by broadcast: their size
is the number of arms, a parameter of the analysis.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import between_days, hash_bucket, safe_ratio
from pulsekit.operators.ranks import exact_quantiles


def user_ctr(feed: DataFrame, first: date, last: date, groups, extra_keys=()) -> DataFrame:
    """Likes, views and CTR per (exp_group, user_id[, extra keys]) in a day window.

    CTR is NULL for a user without views (documented deviation: the source
    engine yields +inf there).
    """
    return (
        feed.where(between_days("time", first, last) & F.col("exp_group").isin(list(groups)))
        .groupBy("exp_group", "user_id", *extra_keys)
        .agg(
            F.count_if(F.col("action") == "like").alias("likes"),
            F.count_if(F.col("action") == "view").alias("views"),
        )
        .withColumn("ctr", safe_ratio("likes", "views"))
    )


def group_ctr(um: DataFrame, group: str = "exp_group") -> DataFrame:
    """Ratio-of-sums CTR per group (the group's "global" CTR)."""
    return um.groupBy(group).agg(
        F.sum("likes").alias("likes"), F.sum("views").alias("views")
    ).withColumn("global_ctr", safe_ratio("likes", "views"))


def column_counts(um: DataFrame, group: str = "exp_group") -> DataFrame:
    """Non-null count of each column per group (a pandas ``groupby().count()``)."""
    cols = [c for c in um.columns if c != group]
    return um.groupBy(group).agg(*[F.count(c).alias(f"n_{c}") for c in cols])


def smoothed_ctr(um: DataFrame, alpha: float = 5.0) -> DataFrame:
    """Laplace-smoothed CTR (likes + alpha * G) / (views + alpha), G = own group's CTR."""
    g = group_ctr(um).select("exp_group", F.col("global_ctr").alias("_g"))
    return (
        um.join(F.broadcast(g), "exp_group")
        .withColumn("smoothed_ctr",  # alpha > 0 keeps the divisor positive; alpha = 0 falls back to NULL
                    F.try_divide(F.col("likes") + F.lit(alpha) * F.col("_g"), F.col("views") + F.lit(alpha)))
        .drop("_g")
    )


def smoothing_effect(sm: DataFrame, control: int, test: int) -> DataFrame:
    """Mean CTR difference (control - test) before and after smoothing, their
    ratio, and per-arm standard deviations, as one row."""
    def arm(g, c):
        return F.when(F.col("exp_group") == g, F.col(c))
    row = sm.agg(
        (F.avg(arm(control, "ctr")) - F.avg(arm(test, "ctr"))).alias("mean_diff_before"),
        (F.avg(arm(control, "smoothed_ctr")) - F.avg(arm(test, "smoothed_ctr"))).alias("mean_diff_after"),
        F.stddev_samp(arm(control, "ctr")).alias("std_ctr_control"),
        F.stddev_samp(arm(control, "smoothed_ctr")).alias("std_smoothed_control"),
        F.stddev_samp(arm(test, "ctr")).alias("std_ctr_test"),
        F.stddev_samp(arm(test, "smoothed_ctr")).alias("std_smoothed_test"),
    )
    return row.withColumn("diff_ratio", F.try_divide("mean_diff_after", "mean_diff_before"))


def pair_members(spark, pairs) -> DataFrame:
    """(control_group, test_group, exp_group) rows for each (control, test) pair."""
    rows = [(int(c), int(t), int(g)) for c, t in pairs for g in (c, t)]
    return spark.createDataFrame(rows, "control_group int, test_group int, exp_group int")


def linearized_likes(um: DataFrame, pairs) -> DataFrame:
    """likes - CTR_control * views for both arms of each (control, test) pair."""
    spark = um.sparkSession
    members = pair_members(spark, pairs)
    ctrl = group_ctr(um).select(F.col("exp_group").alias("control_group"), F.col("global_ctr").alias("_ctrl"))
    return (
        um.join(F.broadcast(members), "exp_group")
        .join(F.broadcast(ctrl), "control_group")
        .select(
            "control_group", "test_group", "exp_group", "user_id", "likes", "views", "ctr",
            (F.col("likes") - F.col("_ctrl") * F.col("views")).alias("linearized_likes"),
        )
    )


def bucket_ctr(um: DataFrame, n_buckets: int = 50) -> DataFrame:
    """Users hashed into ``n_buckets`` per group; ratio-of-sums CTR per (group, bucket)."""
    return (
        um.withColumn("bucket", hash_bucket("user_id", n_buckets))
        .groupBy("exp_group", "bucket")
        .agg(F.count("user_id").alias("users"), F.sum("likes").alias("likes"), F.sum("views").alias("views"))
        .withColumn("bucket_ctr", safe_ratio("likes", "views"))
    )


def bucket_counts(buckets: DataFrame) -> DataFrame:
    return buckets.groupBy("exp_group").agg(
        F.count("bucket").alias("n_buckets"), F.sum("users").alias("n_users"))


def to_long(df: DataFrame, keys: list[str], metrics: list[str], value: str = "value") -> DataFrame:
    """Unpivot ``metrics`` into (metric, value) rows as doubles."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(value)) for m in metrics])
    return df.select(*keys, F.inline(pairs))


def describe(df: DataFrame, by: list[str], metrics: list[str], approx_accuracy: int | None = None) -> DataFrame:
    """count, mean, std, min, 25/50/75 % and max per (by..., metric), nulls skipped.

    Quantiles are exact (interpolated like pandas) and computed without
    collecting any group into one task (see ``ranks``). With
    ``approx_accuracy`` set, they come from ``percentile_approx`` in the same
    single aggregate instead (relative rank error about 1 / accuracy): one
    pass, for very large groups where an approximate quartile suffices.
    """
    long = to_long(df, by, metrics).where(F.col("value").isNotNull())
    keys = [*by, "metric"]
    aggs = [
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    if approx_accuracy:
        pq = F.percentile_approx("value", [0.25, 0.5, 0.75], approx_accuracy)
        out = long.groupBy(*keys).agg(*aggs, pq.alias("_q"))
        return out.select(*keys, "count", "mean", "std", "min", F.col("_q")[0].alias("q25"),
                          F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"), "max")
    moments = long.groupBy(*keys).agg(*aggs)
    q = exact_quantiles(long, keys, "value", [0.25, 0.5, 0.75])
    qw = q.groupBy(*keys).agg(
        F.max(F.when(F.col("q") == 0.25, F.col("quantile"))).alias("q25"),
        F.max(F.when(F.col("q") == 0.5, F.col("quantile"))).alias("q50"),
        F.max(F.when(F.col("q") == 0.75, F.col("quantile"))).alias("q75"),
    )
    return moments.join(qw, keys, "left").select(*keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def ctr_split(um: DataFrame, group: int, threshold: float = 0.2) -> DataFrame:
    """Users of one arm labelled 'low' (ctr < threshold) or 'high'; users without CTR dropped."""
    return (
        um.where((F.col("exp_group") == group) & F.col("ctr").isNotNull())
        .withColumn("segment", F.when(F.col("ctr") < threshold, "low").otherwise("high"))
    )
