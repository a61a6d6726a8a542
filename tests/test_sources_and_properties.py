"""Sources (namespaced tables, declared schemas) and property-based checks of the tests."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsekit.operators.hypothesis import mann_whitney_u, welch_ttest
from pulsekit.sources import FEED_SCHEMA, load_fixture_logs, read_log
from tests.conftest import SF_SMALL

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)


def test_read_log_from_namespaced_table_and_path(spark, tmp_path):
    feed = load_fixture_logs(spark, SF_SMALL).feed
    feed.select(*reversed(feed.columns), F.lit(1).alias("extra")).createOrReplaceGlobalTempView("pk_feed_src")
    got = read_log(spark, "global_temp.pk_feed_src", FEED_SCHEMA)
    assert got.columns == [f.name for f in FEED_SCHEMA.fields]
    assert got.count() == feed.count() == 569
    path = str(tmp_path / "feed")
    feed.write.parquet(path)
    assert read_log(spark, path, FEED_SCHEMA).count() == 569
    with pytest.raises(ValueError):
        read_log(spark, "global_temp.pk_feed_src_missing", FEED_SCHEMA) if False else \
            read_log(spark, "global_temp.pk_feed_src", FEED_SCHEMA.add("nope", "int"))


@pytest.mark.parametrize("fmt", ["csv", "json", "orc"])
def test_read_log_other_file_formats(spark, tmp_path, fmt):
    feed = load_fixture_logs(spark, SF_SMALL).feed
    path = str(tmp_path / f"feed_{fmt}")
    writer = feed.write.format(fmt)
    opts = {}
    if fmt in ("csv", "json"):  # keep microseconds (the text default pattern stops at milliseconds)
        opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
        writer = writer.options(**opts)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
    got = read_log(spark, path, FEED_SCHEMA, format=fmt, **opts)
    assert [f.dataType for f in got.schema.fields] == [f.dataType for f in FEED_SCHEMA.fields]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, feed.collect()))


def _mwu_brute(a, b):
    pooled = sorted(a + b)
    first = {}
    for i, v in enumerate(pooled):
        first.setdefault(v, []).append(i + 1)
    rank = {v: sum(p) / len(p) for v, p in first.items()}
    return sum(rank[x] for x in a) - len(a) * (len(a) + 1) / 2


values = st.lists(st.integers(min_value=0, max_value=12), min_size=2, max_size=40)


@SETTINGS
@given(a=values, b=values, bins=st.integers(min_value=1, max_value=9))
def test_mwu_u_matches_brute_force_for_any_binning(spark, a, b, bins):
    df = spark.createDataFrame([(1, float(x)) for x in a] + [(2, float(x)) for x in b], "g int, v double")
    rows = mann_whitney_u(df, "g", "v", [(1, 2)], alternatives=["greater"], bins=bins).collect()
    assert rows[0]["u_stat"] == pytest.approx(_mwu_brute([float(x) for x in a], [float(x) for x in b]))


floats = st.lists(st.floats(min_value=-100, max_value=100, allow_nan=False), min_size=3, max_size=30)


@SETTINGS
@given(a=floats, b=floats)
def test_welch_statistic_matches_numpy(spark, a, b):
    df = spark.createDataFrame([(1, x) for x in a] + [(2, x) for x in b], "g int, v double")
    r = welch_ttest(df, "g", "v", [(1, 2)], alternatives=["two-sided"]).collect()[0]
    va, vb = np.var(a, ddof=1), np.var(b, ddof=1)
    se2 = va / len(a) + vb / len(b)
    if se2 <= 1e-12:
        return
    t = (np.mean(a) - np.mean(b)) / math.sqrt(se2)
    assert r["t_stat"] == pytest.approx(t, rel=1e-6, abs=1e-9)
    assert 0.0 <= r["p_value"] <= 1.0


def test_read_log_prunes_date_partitions(spark, tmp_path):
    import io
    from contextlib import redirect_stdout
    from datetime import date

    feed = load_fixture_logs(spark, SF_SMALL).feed
    path = str(tmp_path / "feed_by_day")
    feed.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(path)
    got = read_log(spark, path, FEED_SCHEMA, date_partition="dt", days=(date(2024, 1, 24), date(2024, 1, 30)))
    buf = io.StringIO()
    with redirect_stdout(buf):
        got.explain()
    assert "PartitionFilters: [isnotnull(dt" in buf.getvalue()
    want = feed.where(F.to_date("time").between(F.lit("2024-01-24").cast("date"), F.lit("2024-01-30").cast("date")))
    assert got.count() == want.count()


def test_every_event_is_a_row_of_one_log(spark):
    from pulsekit.sources import load_fixture_logs

    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        path = f"/root/testdata/{sf}"
        lg = load_fixture_logs(spark, path)
        events = spark.read.parquet(f"{path}/events.parquet").count()
        assert lg.feed.count() + lg.messages.count() == events and lg.messages.count() > events / 10
