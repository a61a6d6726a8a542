"""Incremental user state: daily appends reproduce the full recomputation."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from pulsekit.operators import audience
from pulsekit.operators import user_state as US
from pulsekit.session import shared_dir
from pulsekit.sources import load_fixture_logs
from tests.conftest import SF_MID


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_incremental_state_equals_full_history(spark):
    lg = load_fixture_logs(spark, SF_MID)
    as_of = date(2024, 1, 31)
    root = shared_dir(spark, "user-state")
    backfill_to = date(2024, 1, 26)
    fs0, us0 = US.initial_state(lg.feed, lg.messages, backfill_to)
    US.write_state(fs0, us0, root, mode="overwrite")
    day = backfill_to + timedelta(days=1)
    while day <= as_of:
        US.update_state(spark, root, lg.feed, lg.messages, day)
        day += timedelta(days=1)
    US.update_state(spark, root, lg.feed, lg.messages, date(2024, 1, 30))  # a retried day adds nothing
    fs, us = US.read_state(spark, root)
    assert fs.count() == fs.select("user_id", "service").distinct().count()
    assert rows(US.acquisition_from_state(fs, us, as_of)) == rows(
        audience.acquisition_by_source(lg.feed, lg.messages, as_of))
    assert rows(US.retention_from_state(lg.feed, lg.messages, fs, as_of)) == rows(
        audience.retention_cohorts(lg.feed, lg.messages, as_of))
    assert rows(US.dau_only_feed_from_state(lg.feed, fs, as_of)) == rows(
        audience.dau_only_feed(lg.feed, lg.messages, as_of))


def test_bucketed_state_tables_join_without_shuffle(spark):
    import io
    from contextlib import redirect_stdout

    lg = load_fixture_logs(spark, SF_MID)
    as_of = date(2024, 1, 31)
    db = "pk_state_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{shared_dir(spark, 'state-db')}'")
    fs0, us0 = US.initial_state(lg.feed, lg.messages, date(2024, 1, 29))
    US.save_state_tables(spark, fs0, us0, db, buckets=8, mode="overwrite")
    US.append_day_to_tables(spark, db, 8, lg.feed, lg.messages, date(2024, 1, 30))
    US.append_day_to_tables(spark, db, 8, lg.feed, lg.messages, date(2024, 1, 30))  # retry: no new rows
    fs, us = spark.table(f"{db}.user_first_seen"), spark.table(f"{db}.user_sources")
    acq = US.acquisition_from_state(fs, us, as_of)
    assert rows(acq) == rows(audience.acquisition_by_source(lg.feed, lg.messages, as_of))
    buf = io.StringIO()
    with redirect_stdout(buf):
        acq.explain()
    plan = buf.getvalue()
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning(user_id" not in plan


def test_incremental_daily_state_equals_full_history(spark):
    lg = load_fixture_logs(spark, SF_MID)
    as_of = date(2024, 1, 31)
    root = shared_dir(spark, "daily-state")
    backfill_to = date(2024, 1, 26)
    US.write_daily_state(US.day_counts(lg.feed, lg.messages, date(2024, 1, 1), backfill_to),
                         US.post_first_seen_initial(lg.feed, backfill_to), root)
    day = backfill_to + timedelta(days=1)
    while day < as_of:
        US.update_daily_state(spark, root, lg.feed, lg.messages, day)
        day += timedelta(days=1)
    US.update_daily_state(spark, root, lg.feed, lg.messages, date(2024, 1, 29))  # retried day
    counts, posts = US.read_daily_state(spark, root)
    assert posts.count() == posts.select("post_id").distinct().count()
    assert rows(US.app_daily_actions_from_state(counts, posts, as_of)) == rows(
        audience.app_daily_actions(lg.feed, lg.messages, as_of))


def test_daily_jobs_backfill_and_rerun(spark):
    from pulsekit.plans import daily
    from pulsekit.sources import read_mart

    lg = load_fixture_logs(spark, SF_MID)
    mart_path = shared_dir(spark, "daily-mart")
    root = shared_dir(spark, "daily-history")
    US.write_state(*US.initial_state(lg.feed, lg.messages, date(2024, 1, 27)), root, mode="overwrite")
    US.write_daily_state(US.day_counts(lg.feed, lg.messages, date(2024, 1, 1), date(2024, 1, 27)),
                         US.post_first_seen_initial(lg.feed, date(2024, 1, 27)), root)
    for as_of in (date(2024, 1, 29), date(2024, 1, 30), date(2024, 1, 31), date(2024, 1, 31)):  # last one: a retry
        daily.load_daily_mart(spark, lg.feed, lg.messages, as_of, mart_path)
        daily.update_history(spark, lg.feed, lg.messages, as_of, root)
    mart = read_mart(spark, mart_path)
    assert sorted(r[0].day for r in mart.select("event_date").distinct().collect()) == [28, 29, 30]
    fs, us = US.read_state(spark, root)
    as_of = date(2024, 1, 31)
    assert rows(US.acquisition_from_state(fs, us, as_of)) == rows(
        audience.acquisition_by_source(lg.feed, lg.messages, as_of))
    counts, posts = US.read_daily_state(spark, root)
    assert rows(US.app_daily_actions_from_state(counts, posts, as_of)) == rows(
        audience.app_daily_actions(lg.feed, lg.messages, as_of))
    full = daily.app_report(spark, lg.feed, lg.messages, as_of)
    recent = [log.where(F.to_date("time") >= F.lit(date(2024, 1, 23))) for log in (lg.feed, lg.messages)]
    from_state = daily.app_report(spark, *recent, as_of, state_root=root)  # 8 days of logs + state
    assert set(full) == set(from_state) == {"figures", "week", "heatmap", "retention_organic", "retention_ads"}
    for name in full:
        assert rows(from_state[name]) == rows(full[name]), name
