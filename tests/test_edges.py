"""Hand-made frames for the semantics pinned in SURVEY 1.4 / FIXTURES 5."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from pulsekit.operators import audience, etl, experiment as X
from pulsekit.operators.histogram import equal_width_histogram
from tests.frames import feed_df, feed_row, msg_df, msg_row, ts

AS_OF = date(2024, 1, 31)
DAY = 30


def collect(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def test_age_bins_including_negative_null_and_boundaries(spark):
    ages = [-5, None, 0, 17, 18, 24, 25, 64, 65, 99]
    rows = [feed_row(i, "view", ts(DAY), age=a) for i, a in enumerate(ages)]
    merged = etl.user_daily_merged(feed_df(spark, rows), msg_df(spark, []), AS_OF)
    out = {r["dimension_value"]: r["views"] for r in etl.metrics_by_dimensions(merged, ("age",)).collect()}
    # [lo, hi) bins; negative and null ages fall into '65+'
    assert out == {"0-18": 2, "18-24": 2, "25-34": 1, "55-64": 1, "65+": 4}


def test_null_slice_key_dropped(spark):
    rows = [feed_row(1, "view", ts(DAY), os=None), feed_row(2, "view", ts(DAY), os="iOS")]
    merged = etl.user_daily_merged(feed_df(spark, rows), msg_df(spark, []), AS_OF)
    out = collect(etl.metrics_by_dimensions(merged, ("os",)), "dimension_value")
    assert [(r["dimension_value"], r["views"]) for r in out] == [("iOS", 1)]


def test_receive_only_user_is_dropped_and_two_os_sender_counts_received_twice(spark):
    msgs = [
        msg_row(1, 2, ts(DAY), os="iOS"),
        msg_row(1, 3, ts(DAY), os="Android"),   # user 1 sends from two OS
        msg_row(3, 1, ts(DAY)),                 # user 1 receives one message
        # user 2 only receives
    ]
    m = collect(etl.message_user_daily(msg_df(spark, msgs), AS_OF), "user_id", "os")
    assert {r["user_id"] for r in m} == {1, 3}
    u1 = [r for r in m if r["user_id"] == 1]
    assert len(u1) == 2 and all(r["messages_received"] == 1 for r in u1)
    assert sum(r["messages_sent"] for r in u1) == 2


def test_zero_view_user_has_null_ctr_and_no_division_error(spark):
    rows = [feed_row(1, "like", ts(25), group=1), feed_row(2, "view", ts(25), group=1),
            feed_row(2, "like", ts(25), group=1)]
    um = collect(X.user_ctr(feed_df(spark, rows), date(2024, 1, 24), date(2024, 1, 30), [1]), "user_id")
    assert um[0]["ctr"] is None and um[0]["likes"] == 1
    assert um[1]["ctr"] == 1.0


def test_ctr_rounds_half_to_even(spark):
    # 1 like per 8 views -> 12.5 % -> 12.5; 9 likes / 40 views = 22.5 % exactly, half-to-even
    rows = [feed_row(1, "view", ts(25)) for _ in range(40)] + [feed_row(1, "like", ts(25)) for _ in range(9)]
    out = audience.feed_daily_metrics(feed_df(spark, rows), AS_OF).collect()[0]
    assert out["ctr"] == 22.5
    rows = [feed_row(1, "view", ts(25)) for _ in range(80)] + [feed_row(1, "like", ts(25)) for _ in range(9)]
    out = audience.feed_daily_metrics(feed_df(spark, rows), AS_OF).collect()[0]
    assert out["ctr"] == 11.2  # 11.25 -> 11.2 (a plain round would give 11.3)


def test_two_source_user_counted_once_per_source(spark):
    feed = feed_df(spark, [feed_row(1, "view", ts(25), source="ads"), feed_row(1, "view", ts(26), source="organic")])
    rc = collect(audience.retention_cohorts(feed, msg_df(spark, []), AS_OF), "action")
    assert [(r["action"].day, r["start"].day, r["source"]) for r in rc] == [(25, 25, "ads"), (26, 25, "organic")]
    acq = collect(audience.acquisition_by_source(feed, msg_df(spark, []), AS_OF), "source")
    assert [(r["source"], r["new_users"]) for r in acq] == [("ads", 1), ("organic", 1)]


def test_day_missing_in_one_log_keeps_its_date(spark):
    feed = feed_df(spark, [feed_row(1, "view", ts(25))])
    msgs = msg_df(spark, [msg_row(2, 3, ts(26))])
    out = collect(audience.app_daily_actions(feed, msgs, AS_OF), "date")
    assert [(r["date"].day, r["messages"], r["views"]) for r in out] == [(25, 0, 1), (26, 1, 0)]


def test_only_messenger_densified_to_active_days(spark):
    feed = feed_df(spark, [feed_row(1, "view", ts(25))])
    msgs = msg_df(spark, [msg_row(1, 5, ts(25)), msg_row(2, 5, ts(26))])
    out = collect(audience.dau_only_messenger(feed, msgs, AS_OF), "date")
    assert [(r["date"].day, r["dau"]) for r in out] == [(25, 0), (26, 1)]


def test_history_cutoff_ignores_rows_after_as_of(spark):
    feed = feed_df(spark, [feed_row(1, "view", ts(20)), feed_row(2, "view", ts(31, 5)),
                           feed_row(3, "view", ts(29))])
    # rows dated after as_of (Jan 29) do not exist yet for a backfill
    acq = audience.acquisition_by_source(feed, msg_df(spark, []), date(2024, 1, 29)).collect()
    assert sorted(r["start"].day for r in acq) == [20]


def test_histogram_constant_series_and_last_bin_closed(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    out = equal_width_histogram(df, "v", 10).collect()
    assert [(r["bin"], r["n"]) for r in out] == [(5, 2)]  # numpy: range [0.5, 1.5]
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "v double")
    out = sorted((r["bin"], r["n"]) for r in equal_width_histogram(df, "v", 4).collect())
    assert out == [(0, 1), (2, 1), (3, 1)]


def test_all_equal_metric_gives_null_welch_and_unit_mwu(spark):
    from pulsekit.operators.hypothesis import mann_whitney_u, welch_ttest
    df = spark.createDataFrame([(1, 0.5), (1, 0.5), (2, 0.5), (2, 0.5)], "g int, v double")
    w = welch_ttest(df, "g", "v", [(1, 2)]).collect()
    assert all(r["t_stat"] is None and r["p_value"] is None for r in w)
    m = mann_whitney_u(df, "g", "v", [(1, 2)]).collect()
    assert all(r["p_value"] == 1.0 and r["u_stat"] == 2.0 for r in m)


def test_group_smaller_than_sample_size_is_an_error(spark):
    import pytest

    from pulsekit.operators import resampling as RS

    df = spark.createDataFrame([(2, i, i / 10) for i in range(5)] + [(3, 100 + i, i / 7) for i in range(50)],
                               "exp_group int, user_id long, ctr double")
    with pytest.raises(ValueError, match="group 2 holds 5 users"):
        RS.aa_samples(df, (2, 3), 4, 10, 42)

def test_welch_zero_variance_different_means_follows_scipy(spark):
    from pulsekit.operators.hypothesis import welch_ttest
    df = spark.createDataFrame([(1, 0.2), (1, 0.2), (2, 0.5), (2, 0.5)], "g int, v double")
    out = {r["alternative"]: r for r in welch_ttest(df, "g", "v", [(1, 2)]).collect()}
    assert out["less"]["t_stat"] == float("-inf") and out["less"]["dof"] == 1.0
    assert (out["less"]["p_value"], out["greater"]["p_value"], out["two-sided"]["p_value"]) == (0.0, 1.0, 0.0)


def test_single_value_tests_return_null_instead_of_failing(spark):
    from pulsekit.operators.hypothesis import mann_whitney_u, welch_ttest
    df = spark.createDataFrame([(1, 0.5)], "g int, v double")
    m = mann_whitney_u(df, "g", "v", [(1, 2)]).collect()
    assert len(m) == 3 and all(r["u_stat"] is None and r["p_value"] is None for r in m)
    w = welch_ttest(df, "g", "v", [(1, 2)]).collect()
    assert all(r["t_stat"] is None and r["p_value"] is None for r in w)


def test_merge_matches_null_keys_like_a_pandas_merge(spark):
    feed = feed_df(spark, [feed_row(5, "view", ts(DAY), age=None), feed_row(5, "like", ts(DAY), age=None)])
    msgs = msg_df(spark, [msg_row(5, 9, ts(DAY), age=None)])
    merged = etl.user_daily_merged(feed, msgs, AS_OF).collect()
    assert len(merged) == 1  # the null age matches on both sides
    r = merged[0]
    assert (r["age"], r["views"], r["likes"], r["messages_sent"], r["users_sent"]) == (None, 1, 1, 1, 1)
    # and the mart's sums agree with summing the merged row
    mart = {(m["dimension"], m["dimension_value"]): m for m in etl.metrics_mart(feed, msgs, AS_OF).collect()}
    assert mart[("age", "65+")]["views"] == 1 and mart[("age", "65+")]["messages_sent"] == 1
