"""One call per daily job of the reference: load the metrics mart, update the
history state, and compute the report data for ``as_of``.

Scheduling stays outside the library: any scheduler can call these functions
with the run's date. Every write is idempotent (dynamic partition overwrite
for the mart and day counts, dated anti-join appends for first-seen state), so
repeated, late and skipped days end in the same state.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from pulsekit.operators import etl, user_state as US
from pulsekit.plans import reports
from pulsekit.sources import publish_mart, write_mart, write_mart_table


def load_daily_mart(spark: SparkSession, feed: DataFrame, messages: DataFrame, as_of: date, target: str,
                    published: bool = False) -> None:
    """The ETL job: the mart rows of ``as_of - 1`` into ``target`` (a path or a catalog table name).

    ``published`` (paths only) loads by a manifest: readers (``read_published_mart``)
    never see a day half replaced."""
    mart = etl.metrics_mart(feed, messages, as_of)
    if published:
        publish_mart(spark, mart, target)
    elif "/" in target:
        write_mart(mart, target)
    else:
        write_mart_table(spark, mart, target)


def _path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _mark_loaded(spark: SparkSession, root: str, day: date, backfill: bool) -> None:
    spark.createDataFrame([(day, backfill)], "day date, backfill boolean").coalesce(1) \
        .write.mode("append").parquet(f"{root}/loaded_days")


def load_day(spark: SparkSession, feed: DataFrame, messages: DataFrame, day: date, root: str) -> None:
    """Fold one day into the state under ``root``; repeated and late days are fine."""
    US.update_state(spark, root, feed, messages, day)
    US.update_daily_state(spark, root, feed, messages, day)
    _mark_loaded(spark, root, day, False)


def missing_days(spark: SparkSession, root: str, upto: date) -> list[date]:
    """Days after the backfill up to ``upto`` that were never loaded (one row a day is read)."""
    rows = spark.read.schema("day date, backfill boolean").parquet(f"{root}/loaded_days").distinct().collect()
    first = max(r["day"] for r in rows if r["backfill"]) + timedelta(days=1)
    loaded = {r["day"] for r in rows}
    return [d for i in range((upto - first).days + 1) if (d := first + timedelta(days=i)) not in loaded]


def update_history(spark: SparkSession, feed: DataFrame, messages: DataFrame, as_of: date, root: str,
                   day_feed: DataFrame | None = None, day_messages: DataFrame | None = None) -> None:
    """Bring the user and daily-count state under ``root`` up to the day before ``as_of``.

    The first run backfills the whole history up to that day in one batch job.
    Later runs load that day and every earlier day that was never loaded.
    ``day_feed`` / ``day_messages`` (reads restricted to the day, e.g. by
    partition pruning) serve the day itself; missing days read the full logs.
    """
    day = as_of - timedelta(days=1)
    if not _path_exists(spark, f"{root}/loaded_days"):
        US.write_state(*US.initial_state(feed, messages, day), root, mode="overwrite")
        US.write_daily_state(US.day_counts(feed, messages, date(1970, 1, 1), day),
                             US.post_first_seen_initial(feed, day), root)
        _mark_loaded(spark, root, day, True)
        return
    for missing in missing_days(spark, root, day - timedelta(days=1)):
        load_day(spark, feed, messages, missing, root)
    load_day(spark, feed if day_feed is None else day_feed, messages if day_messages is None else day_messages,
             day, root)


def app_report(spark: SparkSession, feed: DataFrame, messages: DataFrame, as_of: date,
               state_root: str | None = None) -> dict[str, DataFrame]:
    """Data of the app report job: figures, weekly series and the three matrices.

    With ``state_root`` (kept current by ``update_history``), the figures and
    retention matrices come from the state, so ``feed`` / ``messages`` need to
    cover only the last 8 days; without it, they must cover the whole history.
    """
    from pulsekit.operators import pivots
    out = {"heatmap": pivots.activity_heatmap(feed, messages, as_of)}
    if state_root is not None:
        first_seen, sources = US.read_state(spark, state_root)
        counts, posts = US.read_daily_state(spark, state_root)
        cohorts = US.retention_from_state(feed, messages, first_seen, as_of)
        out["figures"] = US.app_report_from_state(feed, messages, first_seen, sources, counts, posts, as_of)
        acts = US.app_daily_actions_from_state(counts, posts, as_of)
        out["week"] = reports.week_series_from(acts, as_of)
    else:
        from pulsekit.operators import audience
        cohorts = audience.retention_cohorts(feed, messages, as_of)
        out["figures"] = reports.app_report_latest(feed, messages, as_of)
        out["week"] = reports.app_week_series(feed, messages, as_of)
    out["retention_organic"] = pivots.retention_matrix_from(cohorts, as_of, "organic")
    out["retention_ads"] = pivots.retention_matrix_from(cohorts, as_of, "ads")
    return out


def feed_report(feed: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """Data of the feed report job: latest-day figures and the 7-day series."""
    from pulsekit.operators import audience
    return {"latest": reports.feed_report_latest(feed, as_of), "week": audience.feed_daily_metrics(feed, as_of)}
