"""A planted CTR lift is detected by every method."""

import random

from pyspark.sql import functions as F

from pulsekit.operators import experiment as X, resampling as RS
from pulsekit.operators.hypothesis import mann_whitney_u, welch_ttest


def _users(spark, seed=1):
    rng = random.Random(seed)
    rows = []
    for g, p in ((1, 0.20), (2, 0.26)):
        for i in range(1500):
            views = rng.randint(5, 40)
            likes = sum(rng.random() < p for _ in range(views))
            rows.append((g, g * 100000 + i, likes, views, likes / views))
    return spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long, ctr double")


def test_all_methods_detect_a_planted_lift(spark):
    um = _users(spark).cache()
    less = {}
    less["welch_ctr"] = welch_ttest(um, "exp_group", "ctr", [(1, 2)], ["less"]).collect()[0]["p_value"]
    less["mwu_ctr"] = mann_whitney_u(um, "exp_group", "ctr", [(1, 2)], ["less"]).collect()[0]["p_value"]
    sm = X.smoothed_ctr(um, 5.0)
    less["welch_smoothed"] = welch_ttest(sm, "exp_group", "smoothed_ctr", [(1, 2)], ["less"]).collect()[0]["p_value"]
    lin = X.linearized_likes(um, [(1, 2)])
    less["welch_linearized"] = welch_ttest(lin, "exp_group", "linearized_likes", [(1, 2)], ["less"]).collect()[0]["p_value"]
    b = X.bucket_ctr(um, 50)
    less["welch_bucket"] = welch_ttest(b, "exp_group", "bucket_ctr", [(1, 2)], ["less"]).collect()[0]["p_value"]
    less["mwu_bucket"] = mann_whitney_u(b, "exp_group", "bucket_ctr", [(1, 2)], ["less"]).collect()[0]["p_value"]
    pb = RS.poisson_bootstrap_ctr(um, 200, 7)
    diff = RS.replicate_difference(pb, 1, 2).agg(F.avg((F.col("diff") <= 0).cast("double"))).collect()[0][0]
    less["poisson_share_not_positive"] = diff
    bm = RS.bootstrap_means(um, "exp_group", "ctr", 100, 7)
    less["welch_bootstrap"] = welch_ttest(bm, "exp_group", "mean", [(1, 2)], ["less"]).collect()[0]["p_value"]
    assert all(p < 0.01 for p in less.values()), less
    # and the opposite one-sided alternative does not reject
    greater = welch_ttest(um, "exp_group", "ctr", [(1, 2)], ["greater"]).collect()[0]["p_value"]
    assert greater > 0.99
