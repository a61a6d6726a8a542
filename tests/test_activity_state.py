"""Bitset state, bitmaps and sketches against the full recomputations."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulsekit.operators import activity_bits as AB, audience, audience_sketches as AS, drilldown
from pulsekit.session import shared_dir
from pulsekit.sources.manifest import read_manifest
from tests.frames import feed_df, feed_row, msg_df, msg_row

FIRST, AS_OF = date(2023, 10, 2), date(2024, 3, 5)  # three blocks of 56 days begin in between


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def random_logs(spark, seed=1, users=60, n=1500):
    rng = random.Random(seed)
    span = (AS_OF - FIRST).days + 3  # some rows after as_of

    def when():
        return datetime.combine(FIRST, datetime.min.time()) + timedelta(days=rng.randrange(span), minutes=rng.randrange(1440))

    def user():
        return rng.choice([rng.randrange(users), rng.randrange(users) * 7 + 10 ** 9])

    sources = ["ads", "organic", "organic", None]
    feed = [feed_row(user(), rng.choice(["view", "like"]), when(), gender=rng.choice([0, 1, None]),
                     age=rng.choice([None, -1, 15, 30, 70]), os=rng.choice(["iOS", "Android", None]),
                     source=rng.choice(sources), city=rng.choice(["a", "b", "c"])) for _ in range(n)]
    feed += [feed_row(5, "view", datetime(2024, 3, 4, 10))] * 400  # one user with a fifth of all rows
    msgs = [msg_row(user(), 1, when(), source=rng.choice(sources)) for _ in range(n // 2)]
    return feed_df(spark, feed), msg_df(spark, msgs)


@pytest.fixture(scope="module")
def logs(spark):
    return tuple(df.cache() for df in random_logs(spark))


@pytest.fixture(scope="module")
def state(spark, logs):
    """Loads in odd order: history, a day ahead, the days it skipped, a repeated day, days after as_of."""
    root = shared_dir(spark, "bits-test")
    AB.load_activity(spark, root, *logs, FIRST, AS_OF - timedelta(days=6))
    AB.load_activity(spark, root, *logs, AS_OF - timedelta(days=3))
    AB.load_activity(spark, root, *logs, AS_OF - timedelta(days=5), AS_OF - timedelta(days=4))
    AB.load_activity(spark, root, *logs, AS_OF - timedelta(days=3))
    AB.load_activity(spark, root, *logs, AS_OF - timedelta(days=2), AS_OF + timedelta(days=5))
    AB.load_activity(spark, root, *logs, AS_OF + timedelta(days=90))  # a day without rows
    return root


def test_every_cohort_figure_equals_its_full_version(spark, logs, state):
    bits = AB.read_activity(spark, state)
    for as_of in (AS_OF, AS_OF - timedelta(days=20), FIRST + timedelta(days=55), FIRST + timedelta(days=56), FIRST):
        for days in (7, 30):
            assert rows(AB.retention_from_bits(bits, as_of, days)) == rows(audience.retention_cohorts(*logs, as_of, days))
        assert rows(AB.retention_rate_from_bits(bits, as_of, 20)) == rows(audience.retention_rate_by_source(*logs, as_of, 20))
        assert rows(AB.acquisition_from_bits(bits, as_of)) == rows(audience.acquisition_by_source(*logs, as_of))
        first, last = as_of - timedelta(days=80), as_of - timedelta(days=40)
        for source in ("ads", "organic"):
            for feed_only in (False, True):
                assert rows(AB.cohort_dau_from_bits(bits, as_of, source, first, last, feed_only)) == rows(
                    audience.cohort_dau(*logs, as_of, source, first, last, feed_only))


def test_cross_service_audience_from_bits(spark, logs, state):
    bits = AB.read_activity(spark, state)
    for as_of in (AS_OF, date(2023, 12, 26), date(2023, 12, 30), FIRST + timedelta(days=3)):
        for days in (1, 7, 40):
            assert rows(AB.dau_segments_from_bits(bits, as_of, days)) == rows(audience.dau_segments(*logs, as_of, days))
            assert rows(AB.dau_both_same_day_from_bits(bits, as_of, days)) == rows(
                audience.dau_both_same_day(*logs, as_of, days))
    with pytest.raises(ValueError):
        AB.dau_segments_from_bits(bits, AS_OF, 57)


def test_a_day_touches_one_block_and_a_failed_load_changes_nothing(spark, logs, monkeypatch):
    root = shared_dir(spark, "bits-loads")
    AB.load_activity(spark, root, *logs, FIRST, AS_OF)
    before, held = read_manifest(spark, root), rows(AB.read_activity(spark, root))
    assert len(before) >= 3
    with monkeypatch.context() as m:
        m.setattr(AB, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            AB.load_activity(spark, root, *logs, AS_OF + timedelta(days=1))
    assert rows(AB.read_activity(spark, root)) == held
    AB.load_activity(spark, root, *logs, AS_OF)  # again
    after = read_manifest(spark, root)
    assert rows(AB.read_activity(spark, root)) == held
    assert [b for b in after if after[b] != before[b]] == [str(AB._block(AS_OF))]
    recent = AB.read_activity(spark, root, AS_OF, AS_OF)  # one block's folder is read
    assert {r.block for r in recent.select("block").distinct().collect()} == {AB._block(AS_OF)}


def test_empty_state(spark):
    bits = AB.read_activity(spark, shared_dir(spark, "bits-none"))
    assert AB.retention_from_bits(bits, AS_OF).collect() == [] == AB.dau_segments_from_bits(bits, AS_OF).collect()
    assert AB.acquisition_from_bits(bits, AS_OF).collect() == []


def test_drill_down_counts_every_dimension(logs):
    feed = logs[0]
    got = drilldown.dau_change_by_dimensions(feed, AS_OF)
    labelled = feed.withColumns({"gender": F.when(F.col("gender") == 1, "male").otherwise("female"),
                                  "age": drilldown.default_dimensions()["age"]})
    cols = ["date", "dau", "prev_dau", "delta", "pct_change"]
    for name in ("os", "gender", "age", "source", "city"):
        want = audience.dau_change_by(labelled, AS_OF, name).select(*cols, F.col(name).alias("value"))
        assert rows(got.where(F.col("dimension") == name).select(*cols, "value")) == rows(want)
    total = audience.dau_change_by(feed.withColumn("everyone", F.lit("all")), AS_OF, "everyone")
    mine = got.where("dimension = 'total'")
    assert rows(mine.select(cols)) == rows(total.select(cols))
    assert {r.delta_share for r in mine.collect()} <= {1.0, None}
    # users have one city here: the shares of its values are the whole change
    one_city = feed.withColumn("city", F.concat(F.lit("c"), F.pmod("user_id", F.lit(4))))
    sums = drilldown.dau_change_by_dimensions(one_city, AS_OF).where("dimension = 'city'").groupBy("date").agg(
        F.sum("delta_share").alias("s")).where("s is not null").collect()
    assert sums and all(r.s == pytest.approx(1.0) for r in sums)
    first = AS_OF - timedelta(days=10)
    assert rows(drilldown.dau_change_by_dimensions(feed, AS_OF, first=first)) == rows(got.where(F.col("date") >= F.lit(first)))
    custom = drilldown.dau_change_by_dimensions(feed, AS_OF, {"iphone": F.col("os") == "iOS"})
    assert {r.dimension for r in custom.select("dimension").distinct().collect()} == {"total", "iphone"}
    assert drilldown.dau_change_by_dimensions(feed.limit(0), AS_OF).collect() == []


def test_sketches_are_exact_while_small(logs):
    sketches = AS.daily_sketches(*logs, FIRST, AS_OF + timedelta(days=3))
    for as_of in (AS_OF, date(2023, 12, 26), FIRST + timedelta(days=1)):
        got = AS.segments_from_sketches(sketches, as_of)
        assert {r.margin for r in got.collect()} <= {0.0}
        got = got.drop("margin")
        assert rows(got.where(F.col("app") != AS.BOTH_SAME_DAY)) == rows(audience.dau_segments(*logs, as_of))
        same = got.where((F.col("app") == AS.BOTH_SAME_DAY) & (F.col("dau") > 0)).select("date", "dau")
        assert rows(same) == rows(audience.dau_both_same_day(*logs, as_of).select("date", "dau"))
    feed, msgs = ({r.user_id for r in df.where("time < '2024-03-01'").collect()} for df in logs)
    w = AS.window_overlap(sketches, FIRST, date(2024, 2, 29)).first()
    assert (w.either, w.both, w.only_feed, w.only_messenger) == (
        len(feed | msgs), len(feed & msgs), len(feed - msgs), len(msgs - feed))


def test_sketches_stay_within_their_margin(spark):
    day = datetime(2024, 1, 10, 8)
    ids = spark.range(40_000)
    feed = feed_df(spark, []).unionByName(ids.select(
        F.col("id").alias("user_id"), F.lit(1).alias("post_id"), F.lit("view").alias("action"),
        F.lit(day).cast("timestamp_ntz").alias("time"), F.lit(1).alias("gender"), F.lit(20).alias("age"),
        F.lit("iOS").alias("os"), F.lit("ads").alias("source"), F.lit("a").alias("city"), F.lit(1).alias("exp_group")))
    msgs = msg_df(spark, []).unionByName(ids.select(
        (F.col("id") + 25_000).alias("user_id"), F.lit(1).cast("long").alias("reciever_id"),
        F.lit(day).cast("timestamp_ntz").alias("time"), F.lit(1).alias("gender"), F.lit(20).alias("age"),
        F.lit("iOS").alias("os"), F.lit("ads").alias("source")))
    sketches = AS.daily_sketches(feed, msgs, date(2024, 1, 10), date(2024, 1, 10), lg_k=10)
    assert max(len(r.users) for r in sketches.collect()) < 20_000  # bytes, for 40,000 users
    w = AS.window_overlap(sketches, date(2024, 1, 10), date(2024, 1, 10), lg_k=10).first()
    for name, true in (("either", 65_000), ("both", 15_000), ("only_feed", 25_000), ("only_messenger", 25_000)):
        assert 0 < w[f"{name}_margin"] < 0.25 * 65_000 and abs(w[name] - true) <= w[f"{name}_margin"], name
