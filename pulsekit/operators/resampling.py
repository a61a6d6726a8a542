"""Resampling as relational operators: replicates and iterations are keys.

Every random draw is a hash of (seed, key, replicate), never ``rand()``, so
results do not depend on partitioning, task retries or executor loss - a
recomputed partition draws the same numbers.

* ``bootstrap_means``: with-replacement resampling of n values per group.
  Binomial splits deal the n draws of a replicate over bins of users, the draws
  are made inside the bins, and only their sums leave them (``split_draws``).
* ``poisson_bootstrap_ctr``: each user gets a Poisson(1) weight per replicate
  (inverse CDF of a hashed uniform); weighted sums are combined map-side, so
  only (replicate, group) partial sums are shuffled.
* ``aa_simulation``: per iteration, a uniform sample of n users without
  replacement per group, dealt over bins by hypergeometric splits; bins return
  moments, and Welch's test follows per iteration.
* ``aa_samples``: the rows of such samples, from hashed sequential draws into a
  dense index 0..n-1 (hash-prefix bins + bin offsets, so no group is sorted in
  one task).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.columns import poisson1_draw, stable_hash32, stable_uniform
from pulsekit.functions.joins import join_known_small
from pulsekit.operators.hypothesis import welch_from_moments
from pulsekit.operators.split_draws import moments_inside, split_draws, sum_inside
from pulsekit.session import shared_dir

INDEX_BITS = 12  # 4096 hash-prefix bins per group


def dense_index(df: DataFrame, group: str, key: str = "user_id", bits: int = INDEX_BITS) -> DataFrame:
    """Adds ``idx`` = 0..n-1 within each group, ordered by (md5 hash of key, key)."""
    h = stable_hash32(key)
    with_bin = df.withColumn("_h", h).withColumn("_bin", F.shiftright(F.col("_h"), 32 - bits))
    offsets = with_bin.groupBy(group, "_bin").agg(F.count(F.lit(1)).alias("_c")).select(
        group, "_bin",
        F.coalesce(F.sum("_c").over(Window.partitionBy(group).orderBy("_bin")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    in_bin = Window.partitionBy(group, "_bin").orderBy("_h", key)
    # offsets has at most (number of groups) x 2^bits rows
    return (
        with_bin.join(F.broadcast(offsets), [group, "_bin"])
        .withColumn("idx", F.col("_off") + F.row_number().over(in_bin) - 1)
        .drop("_h", "_bin", "_off")
    )


def _spread(df: DataFrame) -> DataFrame:
    """Round-robin the (small) per-user rows over the shuffle partitions before
    they are multiplied by replicates: AQE may have coalesced them into a few
    partitions, which would leave the users x replicates work to a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# Values enter the bootstrap's sums as decimals of 12 places, in two whole numbers (units of 2^24 and the rest):
# sums are exact, so equal draws give equal means under any partitioning and rank tests see stable ties.
_PLACES, _UNIT = 12, 1 << 24


def bootstrap_means(df: DataFrame, group: str, value: str, replicates: int, seed: int,
                    key: str = "user_id") -> DataFrame:
    """Mean of n draws with replacement from each group's n non-null values, per replicate.

    The draws of a replicate are dealt over bins of users by binomial splits and
    drawn inside the bins (``split_draws``), which return their exact sums.
    """
    dec = T.DecimalType(38, 0)
    whole = F.floor(F.col(value).cast(T.DecimalType(38, _PLACES)) * F.lit(10 ** _PLACES).cast(T.DecimalType(13, 0)))
    vals = df.where(F.col(value).isNotNull()).select(group, key, whole.cast(dec).alias("_w"))
    vals = vals.select(group, key, F.floor(F.col("_w") / _UNIT).cast("long").alias("_hi"),
                       F.pmod("_w", F.lit(_UNIT)).cast("long").alias("_lo"))
    sums = split_draws(vals, group, key, ["_hi", "_lo"], replicates, lambda n: n, seed, True, sum_inside,
                       "replicate long, hi long, lo long")
    sizes = vals.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))  # one row per group
    total = F.sum("hi").cast(dec) * F.lit(_UNIT) + F.sum("lo").cast(dec)
    return (
        sums.groupBy("replicate", F.col("_g").alias(group)).agg(total.alias("_sum"))
        .join(F.broadcast(sizes), group)
        .select(F.col("replicate").cast("int").alias("replicate"), group,
                (F.col("_sum").cast("double") / float(10 ** _PLACES) / F.col("_n")).alias("mean"))
    )


def poisson_bootstrap_ctr(um: DataFrame, replicates: int, seed: int, group: str = "exp_group") -> DataFrame:
    """Global CTR per (replicate, group) with Poisson(1) user weights."""
    w = poisson1_draw(stable_uniform(seed, "user_id", "replicate"))
    weighted = (
        _spread(um.select(group, "user_id", "likes", "views"))
        .select(group, "user_id", "likes", "views",
                F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
        .withColumn("_w", w)
    )
    return (
        weighted.groupBy("replicate", group)
        .agg(F.sum(F.col("_w") * F.col("likes")).alias("likes"), F.sum(F.col("_w") * F.col("views")).alias("views"))
        .withColumn("ctr", F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")))
    )


def replicate_difference(boot: DataFrame, control, test, group: str = "exp_group", value: str = "ctr") -> DataFrame:
    """Per replicate: control and test values and test - control."""
    wide = boot.groupBy("replicate").agg(
        F.max(F.when(F.col(group) == control, F.col(value))).alias("ctr_control"),
        F.max(F.when(F.col(group) == test, F.col(value))).alias("ctr_test"),
    )
    return wide.withColumn("diff", F.col("ctr_test") - F.col("ctr_control"))


def draw_budget(m: int, size: int) -> int:
    """Draws after which ``m`` distinct indices out of ``size`` (m at most half
    of size) have come up but for a chance below 1e-20: the mean number of
    draws, size * ln(size / (size - m)), and ten deviations beyond it."""
    mean = size * math.log(size / (size - m))
    return math.ceil(mean + 10 * math.sqrt(mean) + 50)


def aa_samples(um: DataFrame, groups, iterations: int, n: int, seed: int, value: str = "ctr",
               group: str = "exp_group", key: str = "user_id") -> DataFrame:
    """(iteration, group, key, value) rows: n users drawn without replacement per iteration and group.

    Sequential draws with duplicates rejected give a uniform sample without
    replacement: draw j of a cell picks dense index floor(u(seed, iteration,
    group, j) * N), and the first m distinct indices (by j) are drawn. m is n,
    or, when n is more than half of the group, the N - n users left out, so a
    cell never needs more than about 1.4 m draws. The draws of a cell are
    generated after hash-partitioning the small (iteration, group) grid, so
    the windows run without a further shuffle. A group of fewer than n users
    is an error, as it is for a sample without replacement.
    """
    vals = um.where(F.col(group).isin(list(groups)) & F.col(value).isNotNull()).select(group, key, value)
    sizes = {r[group]: r["_N"] for r in vals.groupBy(group).agg(F.count(F.lit(1)).alias("_N")).collect()}
    for g in groups:  # one row per group was fetched
        if sizes.get(g, 0) < n:
            raise ValueError(f"group {g!r} holds {sizes.get(g, 0)} users, fewer than the sample of {n}")
    spark = um.sparkSession
    indexed = dense_index(vals, group, key)
    cells = [(g, size, min(n, size - n), n > size - n) for g, size in sizes.items()]
    budgets = [(g, size, m, draw_budget(m, size)) for g, size, m, _ in cells if m > 0]
    kind = vals.schema[group].dataType.simpleString()
    n_part = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cell = Window.partitionBy("iteration", group)
    first = Window.partitionBy("iteration", group, "idx").orderBy("_j")
    its = F.explode(F.sequence(F.lit(0), F.lit(iterations - 1))).alias("iteration")
    drawn = (
        spark.createDataFrame(budgets, f"{group} {kind}, _N long, _m long, _b long").select("*", its)
        .repartition(n_part, "iteration", group)
        .select("iteration", group, "_N", "_m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_b") - 1)).alias("_j"))
        .withColumn("idx", F.floor(stable_uniform(seed, "iteration", group, "_j") * F.col("_N")))
        .withColumn("_first", F.row_number().over(first)).where(F.col("_first") == 1)
        .withColumn("_rn", F.row_number().over(cell.orderBy("_j")))
        .withColumn("_distinct", F.count(F.lit(1)).over(cell))
        .where(F.when(F.col("_distinct") >= F.col("_m"), F.col("_rn") <= F.col("_m"))
               .otherwise(F.raise_error(F.lit("an A/A cell ran out of draws")).cast("boolean")))
        .select("iteration", group, "idx")
    )
    # written once to the shared checkpoint folder: the draws are not repeated by a lost executor
    shared_dir(spark)
    drawn = drawn.checkpoint(eager=True)
    cols = ["iteration", group, key, value]
    taken = [g for g, _, _, rest in cells if not rest]
    sampled = join_known_small(drawn.where(F.col(group).isin(taken)), indexed, [group, "idx"],
                               small_rows=sum(sizes.values())).select(cols)
    # complement: the sample is at least half of these groups, so users x iterations is about its size
    left_in = (
        _spread(indexed.where(~F.col(group).isin(taken))).select("*", its)
        .join(drawn, ["iteration", group, "idx"], "left_anti").select(cols)
    )
    return sampled.unionByName(left_in)


def aa_simulation(um: DataFrame, a, b, iterations: int, n: int, seed: int, value: str = "ctr",
                  group: str = "exp_group", key: str = "user_id") -> DataFrame:
    """Welch two-sided test of group a vs b on a fresh subsample of n users a group per iteration.

    The n users of a cell are dealt over bins by hypergeometric splits and drawn
    without replacement inside the bins (``split_draws``); a bin returns moments
    about the group's mean, so no task holds a cell and no sampled user is a row.
    A group of fewer than n users is an error.
    """
    vals = um.where(F.col(group).isin(a, b) & F.col(value).isNotNull()).select(
        group, key, F.col(value).cast("double").alias("_x"))
    about = {r[group]: r for r in vals.groupBy(group).agg(  # one row per group
        F.count(F.lit(1)).alias("_n"), F.avg("_x").alias("_c")).collect()}
    for g in (a, b):
        if (have := about[g]["_n"] if g in about else 0) < n:
            raise ValueError(f"group {g!r} holds {have} users, fewer than the sample of {n}")
    centre = F.when(F.col(group) == F.lit(a), F.lit(about[a]["_c"])).otherwise(F.lit(about[b]["_c"]))
    moments = split_draws(
        vals.withColumn("_x", F.col("_x") - centre), group, key, ["_x"], iterations, lambda _: n, seed, False,
        moments_inside, "iteration long, n long, s1 double, s2 double")

    def side(name, g):
        return [F.sum(F.when(F.col("_g") == F.lit(g), F.col(c))).alias(f"{c}_{name}") for c in ("n", "s1", "s2")]

    both = moments.groupBy(F.col("iteration").cast("int").alias("iteration")).agg(*side("a", a), *side("b", b))

    def stats(name, g):
        count, s1, s2 = (F.col(f"{c}_{name}") for c in ("n", "s1", "s2"))
        spread = F.greatest(s2 - s1 * s1 / count, F.lit(0.0))
        return [count.alias(f"n_{name}"), (F.lit(about[g]["_c"]) + s1 / count).alias(f"mean_{name}"),
                F.when(count >= 2, spread / (count - 1)).alias(f"var_{name}")]

    kind = um.schema[group].dataType
    return welch_from_moments(
        both.select("iteration", F.lit(a).cast(kind).alias("group_a"), F.lit(b).cast(kind).alias("group_b"),
                    *stats("a", a), *stats("b", b)), ["iteration"], ["two-sided"])


def false_positive_rate(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    return tests.agg(
        F.count("p_value").alias("iterations"),
        F.count_if(F.col("p_value") <= alpha).alias("significant"),
        F.avg((F.col("p_value") <= alpha).cast("double")).alias("share"),
    )
