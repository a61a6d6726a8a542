"""Mart idempotence and stream = batch on closed windows (with a late event)."""

import os

import pytest
from pyspark.sql import functions as F

from pulsekit.session import shared_dir
from pulsekit.sources import load_fixture_logs, read_mart, write_mart
from pulsekit.operators import etl
from pulsekit.params import AS_OF
from pulsekit.sources.schemas import EVENTS_SCHEMA
from pulsekit.streaming.live import live_feed_metrics, run_live_feed_metrics
from tests.conftest import SF_SMALL


def test_mart_reload_is_idempotent(spark):
    lg = load_fixture_logs(spark, SF_SMALL)
    mart = etl.metrics_mart(lg.feed, lg.messages, AS_OF)
    path = shared_dir(spark, "mart-test")
    write_mart(mart, path)
    once = sorted(map(tuple, read_mart(spark, path).collect()))
    write_mart(mart, path)
    twice = sorted(map(tuple, read_mart(spark, path).collect()))
    assert once == twice and len(once) == 11
    # another day's load leaves the first day untouched
    write_mart(etl.metrics_mart(lg.feed, lg.messages, AS_OF.replace(day=30)), path)
    days = {r[0] for r in read_mart(spark, path).select("event_date").distinct().collect()}
    assert len(days) == 2


def test_mart_catalog_table_created_if_absent_and_reloaded_idempotently(spark):
    from pulsekit.sources import read_mart_table, write_mart_table
    lg = load_fixture_logs(spark, SF_SMALL)
    db_dir = shared_dir(spark, "warehouse")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pk_mart_test LOCATION '{db_dir}'")
    table = "pk_mart_test.metrics_mart"
    day1 = etl.metrics_mart(lg.feed, lg.messages, AS_OF)
    write_mart_table(spark, day1, table)
    write_mart_table(spark, day1, table)
    write_mart_table(spark, etl.metrics_mart(lg.feed, lg.messages, AS_OF.replace(day=30)), table)
    got = read_mart_table(spark, table)
    day = AS_OF.replace(day=30)  # the first load's event_date
    assert got.select("event_date").distinct().count() == 2
    assert sorted(map(tuple, got.where(F.col("event_date") == F.lit(day)).collect())) == \
        sorted(map(tuple, day1.select(got.columns).collect()))


def test_published_mart_shows_a_day_before_or_after_a_load(spark, monkeypatch):
    from pulsekit.plans.daily import load_daily_mart
    from pulsekit.sources import clean_mart, publish_mart, read_published_mart
    from pulsekit.sources import mart as M
    lg = load_fixture_logs(spark, SF_SMALL)
    path = shared_dir(spark, "published-mart-test")
    assert read_published_mart(spark, path).collect() == []
    load_daily_mart(spark, lg.feed, lg.messages, AS_OF, path, published=True)
    day = AS_OF.replace(day=30)
    whole = etl.metrics_mart(lg.feed, lg.messages, AS_OF)
    cols = read_published_mart(spark, path).columns
    want = sorted(map(tuple, whole.select(cols).collect()))
    assert sorted(map(tuple, read_published_mart(spark, path).collect())) == want
    # a load of a changed day that dies after some files: the old day stays readable
    with monkeypatch.context() as m:
        m.setattr(M, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            publish_mart(spark, whole.limit(2), path)
    assert sorted(map(tuple, read_published_mart(spark, path).collect())) == want
    reader = read_published_mart(spark, path)  # planned before the next load
    publish_mart(spark, whole.withColumn("views", F.lit(7).cast("long")), path)
    assert sorted(map(tuple, reader.collect())) == want  # still the version it started with
    assert {r.views for r in read_published_mart(spark, path).collect()} == {7}
    publish_mart(spark, etl.metrics_mart(lg.feed, lg.messages, day), path)
    assert read_published_mart(spark, path).select("event_date").distinct().count() == 2
    one = read_published_mart(spark, path, day.isoformat(), day.isoformat())
    assert one.select("event_date").distinct().count() == 1
    assert clean_mart(spark, path) == 2 and clean_mart(spark, path) == 0
    assert read_published_mart(spark, path).select("event_date").distinct().count() == 2


def _local(uri: str) -> str:
    return uri[len("file:"):] if uri.startswith("file:") else uri


def test_stream_equals_batch_on_closed_windows_and_drops_late_rows(spark):
    from pulsekit.sources.logs import logs_from_events

    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{SF_SMALL}/events.parquet")
    ts = F.col("ts")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    # a feed action from Jan 1-9
    late_row = events.where(
        (ts < F.lit("2024-01-10").cast("timestamp_ntz")) & (F.col("event_type") == "view") & (F.col("user_id") % 5 == 3)
    ).orderBy("event_id").limit(1).withColumns({
        "event_id": F.lit(10_000_000).cast("long")})
    assert logs_from_events(late_row).feed.count() == 1  # it would count if it were not late
    src = shared_dir(spark, "stream-src")
    parts = {"a": events.where(ts < cut), "b": events.where(ts >= cut), "c": late_row}
    for name, df in parts.items():
        df.coalesce(1).write.parquet(os.path.join(src, name))
    flat = shared_dir(spark, "stream-flat")
    os.makedirs(_local(flat))
    # three micro-batches in this order: early days, later days (advances the watermark), the late row
    for i, name in enumerate(["a", "b", "c"]):
        (f,) = [os.path.join(dp, x) for dp, _, fs in os.walk(os.path.join(_local(src), name))
                for x in fs if x.endswith(".parquet")]
        target = os.path.join(_local(flat), f"events-{name}.parquet")
        os.link(f, target)
        os.utime(target, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    got = run_live_feed_metrics(spark, flat, max_files_per_trigger=1)
    feed = load_fixture_logs(spark, SF_SMALL).feed
    max_time = feed.agg(F.max("time")).collect()[0][0]
    closed = live_feed_metrics(feed).where(F.col("window_end") <= F.lit(max_time) - F.expr("INTERVAL 10 MINUTES"))
    cols = ["window_start", "views", "likes", "events"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, closed.select(cols).collect()))


def test_continuous_live_query_matches_the_available_now_run(spark):
    from pulsekit.streaming.live import start_live_feed_metrics

    root = shared_dir(spark, "live-continuous")
    q = start_live_feed_metrics(spark, SF_SMALL, f"{root}/out", f"{root}/ckpt", every="1 second",
                                glob="events.parquet")
    try:
        q.processAllAvailable()
        q.processAllAvailable()  # a further (no-data) batch closes the windows the watermark passed
    finally:
        q.stop()
    got = spark.read.parquet(f"{root}/out")
    once = run_live_feed_metrics(spark, SF_SMALL, glob="events.parquet")
    cols = ["window_start", "views", "likes", "events"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, once.select(cols).collect()))


def test_live_windows_do_not_depend_on_the_session_time_zone(spark):
    feed = load_fixture_logs(spark, SF_SMALL).feed
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    try:
        results = []
        for tz in ("UTC", "Asia/Kolkata"):  # a fractional-hour offset would shift a cast-based window grid
            spark.conf.set(key, tz)
            results.append(sorted(map(tuple, live_feed_metrics(feed).select(
                "window_start", "window_end", "views", "likes").collect())))
    finally:
        spark.conf.set(key, before)
    assert results[0] == results[1]
    assert all(r[0].minute == 0 for r in results[0])
