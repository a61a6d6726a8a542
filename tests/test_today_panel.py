"""The live panel with the open hour: stored table = batch aggregate after every micro-batch."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pulsekit.session import shared_dir
from pulsekit.sources import load_fixture_logs
from pulsekit.sources.logs import logs_from_events
from pulsekit.sources.manifest import list_names, publish, read_manifest
from pulsekit.sources.schemas import EVENTS_SCHEMA
from pulsekit.streaming import live
from tests.conftest import SF_SMALL

COLUMNS = ["window_start", "window_end", "views", "likes", "events", "active_users"]


def _local(uri: str) -> str:
    return uri[len("file:"):] if uri.startswith("file:") else uri


def rows(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()))


@pytest.fixture(scope="module")
def batches(spark):
    """Three files in time order; the second and third both reach into hours of the one before."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{SF_SMALL}/events.parquet").cache()
    at = [datetime(2024, 1, 12, 9, 30), datetime(2024, 1, 21, 17, 45)]
    ts, late = F.col("ts"), F.col("event_id") % 7 == 0
    cuts = [F.lit(x).cast("timestamp_ntz") for x in at]
    near = [ts.between(c - F.expr("INTERVAL 20 MINUTES"), c) & late for c in cuts]  # these come a batch later
    part = F.when((ts < cuts[0]) & ~near[0], 0).when((ts < cuts[1]) & ~near[1], 1).otherwise(2)
    return [events.where(part == i) for i in range(3)]


def add_file(df, folder: str, i: int) -> None:
    src = shared_dir(df.sparkSession, "panel-src")
    df.coalesce(1).write.parquet(src)
    (f,) = [os.path.join(_local(src), x) for x in os.listdir(_local(src)) if x.endswith(".parquet")]
    os.makedirs(_local(folder), exist_ok=True)
    target = os.path.join(_local(folder), f"events-{i}.parquet")
    os.link(f, target)
    os.utime(target, (1_700_000_000 + 100 * i,) * 2)


def test_panel_equals_the_batch_aggregate_after_every_micro_batch(spark, batches):
    folder, root = shared_dir(spark, "panel-in"), shared_dir(spark, "panel")
    seen = None
    for i, df in enumerate(batches):
        add_file(df, folder, i)
        seen = df if seen is None else seen.unionByName(df)
        got = live.run_today_panel(spark, folder, root, delay="30 minutes")
        want = live.live_feed_metrics(logs_from_events(seen).feed)
        assert rows(got) == rows(want)
        last = logs_from_events(seen).feed.agg(F.max("time")).first()[0]
        assert got.agg(F.max("window_end")).first()[0] > last  # the open hour is there
    assert rows(got) == rows(live.live_feed_metrics(load_fixture_logs(spark, SF_SMALL).feed))


def test_a_replayed_batch_changes_nothing(spark, batches):
    root = shared_dir(spark, "panel-replay")

    def update(upto):
        seen = batches[0]
        for df in batches[1:upto + 1]:
            seen = seen.unionByName(df)
        all_pairs = live.user_window_updates(logs_from_events(seen).feed)
        if upto == 0:
            return all_pairs
        # what update mode emits: the current totals of the pairs the batch touched
        touched = live.user_window_updates(logs_from_events(batches[upto]).feed).select("window_start", "user_id")
        return all_pairs.join(touched, ["window_start", "user_id"], "left_semi").select(all_pairs.columns)

    states = []
    for i in range(3):
        live.upsert_panel(update(i), i, root)
        states.append(rows(live.read_today_panel(spark, root)))
        for again in range(i + 1):  # this batch once more, and earlier ones
            live.upsert_panel(update(again), again, root)
            assert rows(live.read_today_panel(spark, root)) == states[-1]
    assert states[2] == rows(live.live_feed_metrics(load_fixture_logs(spark, SF_SMALL).feed))
    assert len(list_names(spark, f"{root}/panel")) <= 2
    live.upsert_panel(update(2).limit(0), 3, root)
    assert rows(live.read_today_panel(spark, root)) == states[2]
    # closed windows keep their rows when their stored pairs go
    assert live.retire_changes(spark, root, datetime(2024, 1, 15)) > 0
    assert live.retire_changes(spark, root, datetime(2024, 1, 15)) == 0
    assert rows(live.read_today_panel(spark, root)) == states[2]


def test_a_batch_that_dies_before_publishing_leaves_the_panel(spark, batches, monkeypatch):
    root = shared_dir(spark, "panel-dies")
    first = live.user_window_updates(logs_from_events(batches[0]).feed)
    live.upsert_panel(first, 0, root)
    before = rows(live.read_today_panel(spark, root))
    both = live.user_window_updates(logs_from_events(batches[0].unionByName(batches[1])).feed)
    with monkeypatch.context() as m:
        m.setattr(live, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            live.upsert_panel(both, 1, root)
    assert rows(live.read_today_panel(spark, root)) == before
    live.upsert_panel(both, 1, root)
    assert rows(live.read_today_panel(spark, root)) == rows(
        live.live_feed_metrics(logs_from_events(batches[0].unionByName(batches[1])).feed))


def test_the_aggregation_of_a_batch_stays_spread_over_its_tasks(spark, batches, monkeypatch):
    root = shared_dir(spark, "panel-plan")
    writer, plans = type(batches[0].write), []
    real = writer.parquet

    def spy(self, path, *args, **kwargs):
        if "/panel/" in path:
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return real(self, path, *args, **kwargs)

    monkeypatch.setattr(writer, "parquet", spy)
    for i in range(2):
        live.upsert_panel(live.user_window_updates(logs_from_events(batches[i]).feed), i, root)
    assert len(plans) == 2
    for plan in plans:
        # the last step before the write is a shuffle, so no task holds the hash maps of several partitions
        assert not re.search(r"^\W*Coalesce\b", plan, re.MULTILINE)
        assert plan.index("Exchange") < plan.index("Aggregate")


def test_empty_panel(spark):
    assert live.read_today_panel(spark, shared_dir(spark, "panel-none")).collect() == []


def test_continuous_panel(spark):
    root = shared_dir(spark, "panel-continuous")
    q = live.start_today_panel(spark, SF_SMALL, root, every="1 second", glob="events.parquet")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(live.read_today_panel(spark, root)) == rows(live.live_feed_metrics(load_fixture_logs(spark, SF_SMALL).feed))


def test_manifest_numbers_are_taken_once(spark):
    root = shared_dir(spark, "manifest")
    assert read_manifest(spark, root) == {}
    assert publish(spark, root, {"a": "x"}) == {"a": "x"}
    assert publish(spark, root, {"b": "y"}) == {"a": "x", "b": "y"}
    # another writer is faster: the number it read is gone, its entries are kept
    from pulsekit.sources import manifest
    real, calls = manifest._latest, []

    def stale(s, r):
        calls.append(1)
        return (1, {"a": "x"}) if len(calls) == 1 else real(s, r)

    manifest._latest = stale
    try:
        assert publish(spark, root, {"a": "z"}) == {"a": "z", "b": "y"}
    finally:
        manifest._latest = real
    assert len(calls) == 2 and read_manifest(spark, root) == {"a": "z", "b": "y"}
