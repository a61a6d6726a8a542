"""Resampling by splitting counts: against exact laws, plain draws and the whole group."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsekit.operators import resampling as RS, split_draws as SD

SCHEMA = "exp_group int, user_id long, ctr double"


def arms(spark, n, groups=(2, 3), seed=1):
    rng = random.Random(seed)
    return spark.createDataFrame([(g, g * 10 ** 7 + i, rng.random()) for g in groups for i in range(n)], SCHEMA)


def test_left_share_is_the_exact_inverse_distribution():
    rng = random.Random(8)
    for replace in (True, False):
        rows = []
        for _ in range(400):
            total = rng.randrange(1, 40)
            left, m = rng.randrange(0, total + 1), rng.randrange(0, (60 if replace else total) + 1)
            rows.append((rng.random(), m, left, total))
        got = SD.left_share(*(np.array(x) for x in zip(*rows)), replace)
        for (u, m, left, total), k in zip(rows, got):
            if replace:
                law = [Fraction(math.comb(m, i) * left ** i * (total - left) ** (m - i), total ** m) for i in range(m + 1)]
            else:
                law = [Fraction(math.comb(left, i) * math.comb(total - left, m - i), math.comb(total, m)) for i in range(m + 1)]
            cdf, want = Fraction(0), m
            for i, p in enumerate(law):
                cdf += p
                if cdf >= Fraction(u):
                    want = i
                    break
            assert k == want, (u, m, left, total, replace)


def test_left_share_of_large_counts_has_the_right_moments():
    u = np.random.default_rng(3).random(4000)
    m, left, total = 10 ** 6, 3 * 10 ** 6, 10 ** 7
    for replace, var in ((True, m * 0.21), (False, m * 0.21 * (total - m) / (total - 1))):
        k = SD.left_share(u, np.full(4000, m), np.full(4000, left), np.full(4000, total), replace)
        assert abs(k.mean() - 0.3 * m) < 4 * math.sqrt(var / 4000) and abs(k.var() / var - 1) < 0.1


def test_counts_add_up_and_follow_the_sizes():
    sizes = np.array([3, 0, 5, 1, 9, 2, 0, 12])
    base = np.arange(5000, dtype=np.int64) * 2654435761 % 2 ** 32
    with_back = SD.bin_counts(sizes, 200, base, True)
    without = SD.bin_counts(sizes, 20, base, False)
    assert (with_back.sum(axis=1) == 200).all() and (without.sum(axis=1) == 20).all()
    assert (without <= sizes).all() and (with_back[:, sizes == 0] == 0).all()
    p = sizes / sizes.sum()
    assert np.abs(with_back.mean(axis=0) - 200 * p).max() < 0.5 and np.abs(without.mean(axis=0) - 20 * p).max() < 0.1
    assert np.abs(with_back.var(axis=0) - 200 * p * (1 - p)).max() < 4
    assert (SD.bin_counts(sizes, 32, base, False) == sizes).all()  # everybody is drawn


def test_distinct_picks_are_the_first_different_draws():
    base = np.arange(200, dtype=np.int64) * 40503 + 17
    want = np.arange(200) % 20
    row, idx = SD.pick_distinct(base, 3, want, 40)
    for r in range(200):
        draws = SD.draw_index(np.full(2000, base[r]), 3, np.arange(2000), 40)
        assert list(idx[row == r]) == list(dict.fromkeys(draws.tolist()))[:want[r]]


def _mix(x):
    x = (x ^ x >> 16) * SD.MULT_1 % 2 ** 32
    x = (x ^ x >> 13) * SD.MULT_2 % 2 ** 32
    return x ^ x >> 16


def plain_bootstrap(users, replicates, seed):
    """{(replicate, group): mean}: the tree and the draws written out in integers and fractions."""
    groups = {}
    for g, user, v in users:
        h = int(hashlib.md5(str(user).encode()).hexdigest()[:8], 16)
        groups.setdefault(g, []).append((h, user, v))
    bits = SD.group_bits(max(map(len, groups.values())))
    out = {}
    for g, members in groups.items():
        for rep in range(replicates):
            base = int(hashlib.md5(f"{seed}:{g}:{rep}".encode()).hexdigest()[:8], 16)

            def descend(level, prefix, mine, m):
                if level == bits:
                    mine, size = sorted(mine), len(mine)
                    start = _mix((_mix(base) + (prefix + 1) * SD.BIN_STEP) % 2 ** 32)
                    return sum(mine[_mix((start + j * SD.STEP) % 2 ** 32) * size >> 32][2] for j in range(m))
                left = [x for x in mine if not x[0] >> (31 - level) & 1]
                right = [x for x in mine if x[0] >> (31 - level) & 1]
                node = (1 << level) + prefix
                at = base + node * 2 * SD.STEP
                u = Fraction(_mix(at % 2 ** 32) * 2 ** 20 + (_mix((at + SD.STEP) % 2 ** 32) >> 12), 2 ** 52)
                cdf, k = Fraction(0), -1
                while cdf < u or k < 0:
                    k += 1
                    cdf += Fraction(math.comb(m, k) * len(left) ** k * len(right) ** (m - k), len(mine) ** m)
                total = descend(level + 1, 2 * prefix, left, k) if k else 0
                return total + (descend(level + 1, 2 * prefix + 1, right, m - k) if m > k else 0)

            out[rep, g] = descend(0, 0, members, len(members)) / len(members)
    return out


def test_bootstrap_equals_the_plain_tree(spark):
    rng = random.Random(2)
    users = [(g, g * 1000 + i, rng.randrange(0, 1000) / 1024) for g, n in ((1, 90), (2, 37), (5, 1)) for i in range(n)]
    df = spark.createDataFrame([*users, (1, 77_777, None)], SCHEMA).repartition(3)
    got = {(r.replicate, r.exp_group): r["mean"] for r in RS.bootstrap_means(df, "exp_group", "ctr", 25, 42).collect()}
    want = plain_bootstrap(users, 25, 42)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-11)


def test_bootstrap_of_a_large_arm(spark):
    """300,000 users: replicate means have the mean and the spread of resampled means; nothing but counts is joined."""
    df = spark.range(300_000).select(F.lit(1).alias("exp_group"), F.col("id").alias("user_id"),
                                     ((F.col("id") * 7919) % 1000 / 1000.0).alias("ctr"))
    boot = RS.bootstrap_means(df, "exp_group", "ctr", 60, 7)
    means = np.array([r["mean"] for r in boot.collect()])
    true_sd = math.sqrt((1000 ** 2 - 1) / 12) / 1000 / math.sqrt(300_000)
    assert len(means) == 60 and abs(means.mean() - 0.4995) < 5 * true_sd / math.sqrt(60)
    assert 0.7 < means.std(ddof=1) / true_sd < 1.35
    plan = boot._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan


def test_bootstrap_of_nothing_and_of_string_groups(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert RS.bootstrap_means(empty, "exp_group", "ctr", 5, 1).collect() == []
    named = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 2.0), ("b", 3, -7.25)], "exp_group string, user_id long, ctr double")
    got = {(r.exp_group, r["mean"]) for r in RS.bootstrap_means(named, "exp_group", "ctr", 3, 1).collect()}
    assert got == {("a", 2.0), ("b", -7.25)}


def test_aa_simulation_draws_without_replacement(spark):
    um = arms(spark, 200)
    whole = {r.exp_group: (r.n, r.m, r.v) for r in um.groupBy("exp_group").agg(
        F.count("*").alias("n"), F.avg("ctr").alias("m"), F.var_samp("ctr").alias("v")).collect()}
    for r in RS.aa_simulation(um, 2, 3, 15, 200, 42).collect():  # everybody: the groups themselves
        for side, g in (("a", 2), ("b", 3)):
            assert (r[f"n_{side}"], r[f"mean_{side}"], r[f"var_{side}"]) == pytest.approx(whole[g], rel=1e-9)
    runs = RS.aa_simulation(um, 2, 3, 800, 60, 42).collect()
    assert {(r.n_a, r.n_b) for r in runs} == {(60, 60)} and len(runs) == 800
    means = np.array([r.mean_a for r in runs])
    sd = math.sqrt(whole[2][2] / 60 * (1 - 60 / 200))  # without replacement
    assert abs(means.mean() - whole[2][1]) < 4 * sd / math.sqrt(800) and 0.88 < means.std(ddof=1) / sd < 1.12
    with pytest.raises(ValueError, match="holds 200 users"):
        RS.aa_simulation(um, 2, 3, 5, 201, 42)


def test_aa_false_positives_within_binomial_error(spark):
    rng = random.Random(4)
    values = [rng.random() for _ in range(2000)]  # two arms of the same values: no difference to find
    um = spark.createDataFrame([(g, g * 10 ** 7 + i, v) for g in (2, 3) for i, v in enumerate(values)], SCHEMA)
    share = RS.false_positive_rate(RS.aa_simulation(um, 2, 3, 3000, 100, 42)).first()["share"]
    # a sample without replacement varies less by 1 - 100/2000, which the test does not know
    level = math.erfc(1.984 / math.sqrt(0.95) / math.sqrt(2))
    assert abs(share - level) < 4 * math.sqrt(level * (1 - level) / 3000)


def test_aa_simulation_of_a_small_share_of_a_large_arm(spark):
    """500 of 200,000 users: most bins give nobody, and no user becomes a row."""
    df = spark.range(400_000).select((2 + F.col("id") % 2).cast("int").alias("exp_group"), F.col("id").alias("user_id"),
                                     (F.xxhash64("id") % 1000 / 1000.0).alias("ctr"))
    tests = RS.aa_simulation(df, 2, 3, 50, 500, 1)
    assert {(r.n_a, r.n_b) for r in tests.collect()} == {(500, 500)}
    plan = tests._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "Generate explode([two-sided])" in plan  # the alternatives only
