"""Live feed metrics on Structured Streaming.

The dashboard's "today" panel becomes an event-time aggregation: feed
actions -> watermark -> tumbling windows per user -> the same windows over
users: views, likes, CTR and the exact number of active users (two chained
aggregations under one watermark). Append mode emits a window once the watermark passes its end, so
each window is written exactly once and late rows beyond the watermark are
dropped. The sink and checkpoint live under the shared checkpoint folder.

The "today" panel shows the open hour as well: one aggregation per (window,
user) in update mode, whose changed rows ``upsert_panel`` merges into the stored
panel after every micro-batch (see there).
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.session import shared_dir
from pulsekit.sources.logs import logs_from_events
from pulsekit.sources.manifest import list_names, publish, read_manifest, remove
from pulsekit.sources.schemas import EVENTS_SCHEMA


def _epoch_ntz():
    # a typed NTZ literal: F.lit(datetime) would be a zone-aware TIMESTAMP
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def _ntz_to_instant(c):
    """The instant whose UTC rendering is the wall-clock value (independent of the session zone)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), c))


def _instant_to_ntz(c):
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def _per_user(feed: DataFrame, window: str, delay: str) -> DataFrame:
    """Views, likes and events per (window, user)."""
    return (
        feed.withColumn("event_time", _ntz_to_instant(F.col("time")))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window), "user_id")
        .agg(
            F.count_if(F.col("action") == "view").alias("views"),
            F.count_if(F.col("action") == "like").alias("likes"),
            F.count(F.lit(1)).alias("events"),
        )
    )


def live_feed_metrics(feed: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Windowed feed KPIs; works on a streaming or a batch feed frame.

    ``time`` is a wall-clock TIMESTAMP_NTZ; watermarks need TIMESTAMP, so it is
    mapped to the instant with the same UTC rendering by epoch arithmetic (a
    plain cast would go through the session time zone and shift the window
    grid in zones with a fractional-hour offset), and mapped back on output.
    """
    per_user = _per_user(feed, window, delay)
    return (
        per_user.groupBy(F.window(F.window_time("window"), window))
        .agg(F.sum("views").alias("views"), F.sum("likes").alias("likes"), F.sum("events").alias("events"),
             F.count("user_id").alias("active_users"))
        .select(
            _instant_to_ntz(F.col("window.start")).alias("window_start"),
            _instant_to_ntz(F.col("window.end")).alias("window_end"),
            "views", "likes", "events",
            F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")).alias("ctr"),
            "active_users",
        )
    )


def run_live_feed_metrics(spark: SparkSession, events_dir: str, window: str = "1 hour", delay: str = "10 minutes",
                          glob: str = "events*.parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the live query over the files available now and return the emitted windows.

    The source is a Parquet folder of raw events (new files are picked up
    incrementally); output and checkpoint go to a fresh folder under the
    session's shared checkpoint dir, so a restarted job resumes from its
    checkpoint instead of recomputing.
    """
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(events_dir)
    metrics = live_feed_metrics(logs_from_events(events).feed, window, delay)
    root = shared_dir(spark, "live-feed")
    out, ckpt = f"{root}/out", f"{root}/checkpoint"
    query = (
        metrics.writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(out)


def start_live_feed_metrics(spark: SparkSession, events_dir: str, out_path: str, checkpoint_path: str,
                            window: str = "1 hour", delay: str = "10 minutes", every: str = "1 minute",
                            glob: str = "events*.parquet"):
    """Start the live query for good: micro-batches every ``every``, closed
    windows appended to ``out_path`` (Parquet), progress in ``checkpoint_path``
    (both in shared storage, so a restarted job resumes where it stopped).
    Returns the ``StreamingQuery``."""
    events = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob).parquet(events_dir)
    metrics = live_feed_metrics(logs_from_events(events).feed, window, delay)
    return (
        metrics.writeStream.outputMode("append").format("parquet")
        .option("path", out_path).option("checkpointLocation", checkpoint_path)
        .trigger(processingTime=every)
        .start()
    )


# ---------------------------------------------------------------- the "today" panel
_SLOT = "yyyy-MM-dd-HH-mm-ss"
PANEL_SCHEMA = ("window_start timestamp_ntz, window_end timestamp_ntz, views long, likes long, events long, ctr double, "
                "active_users long")
_CHANGE_SCHEMA = ("window_start timestamp_ntz, window_end timestamp_ntz, user_id long, views long, likes long, events long, "
                  "slot string, batch long")


def user_window_updates(feed: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Current totals per (window, user); in update mode a micro-batch emits the pairs it changed."""
    return _per_user(feed, window, delay).select(
        _instant_to_ntz(F.col("window.start")).alias("window_start"),
        _instant_to_ntz(F.col("window.end")).alias("window_end"), "user_id", "views", "likes", "events")


def _changes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_CHANGE_SCHEMA).parquet(f"{root}/changes")


def upsert_panel(updates: DataFrame, batch_id: int, root: str) -> None:
    """Merge one micro-batch's (window, user) totals into the panel under ``root``.

    The changed pairs are stored in the folder of their window and batch, which
    a repeated batch overwrites with the same rows. Then the windows that the
    batch touched are totalled from each user's latest pair (by batch id), only their
    folders are read, and the panel with these windows replaced is written to a
    folder of its own and put into force by the manifest. So a batch that is run
    again, in part or in whole, changes nothing, and a reader never sees half a
    panel. Exact users need no distinct count: a user is one row a window.
    """
    spark = updates.sparkSession
    changed = updates.withColumns({
        "slot": F.date_format("window_start", _SLOT), "batch": F.lit(int(batch_id)).cast("long")}).persist()
    try:
        touched = [r.slot for r in changed.select("slot").distinct().collect()]  # one name per window of the batch
        if not touched:
            return
        # about one file a window when there are many, and the open hour over all tasks when it is alone
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.xxhash64("user_id"), F.lit(-(-tasks // len(touched))))
        (
            changed.repartition(tasks, "slot", salt)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch")
            .parquet(f"{root}/changes")
        )
    finally:
        changed.unpersist()
    totals = F.struct("views", "likes", "events")
    windows = (
        _changes(spark, root).where(F.col("slot").isin(touched))
        .groupBy("window_start", "window_end", "user_id").agg(F.max_by(totals, "batch").alias("t"))
        .groupBy("window_start", "window_end")
        .agg(*[F.sum(f"t.{c}").alias(c) for c in ("views", "likes", "events")], F.count("user_id").alias("active_users"))
        .select("window_start", "window_end", "views", "likes", "events",
                F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")).alias("ctr"), "active_users")
    )
    before = read_today_panel(spark, root).where(~F.date_format("window_start", _SLOT).isin(touched))
    folder = f"panel/{batch_id:012d}-{uuid.uuid4().hex[:12]}"
    # the files follow the size of the panel, after a shuffle: a plain coalesce would pull the aggregation of
    # all shuffle partitions into its one task, each with a hash map of its own
    before.unionByName(windows).hint("rebalance").write.parquet(f"{root}/{folder}")
    old = read_manifest(spark, root).get("panel")
    publish(spark, root, {"panel": folder})
    for name in list_names(spark, f"{root}/panel"):  # a reader may still be on the version just replaced
        if f"panel/{name}" not in (folder, old):
            remove(spark, f"{root}/panel/{name}")


def read_today_panel(spark: SparkSession, root: str) -> DataFrame:
    """The panel in force: one row per window, the open one included."""
    folder = read_manifest(spark, root).get("panel")
    if folder is None:
        return spark.createDataFrame([], PANEL_SCHEMA)
    return spark.read.schema(PANEL_SCHEMA).parquet(f"{root}/{folder}")


def retire_changes(spark: SparkSession, root: str, before: datetime) -> int:
    """Remove the stored pairs of windows that start before ``before``; to be called with a time
    whose windows the watermark has passed, which no later batch can touch. The panel keeps its rows."""
    gone = [n for n in list_names(spark, f"{root}/changes")
            if n.startswith("slot=") and n[5:] < before.strftime("%Y-%m-%d-%H-%M-%S")]
    for name in gone:
        remove(spark, f"{root}/changes/{name}")
    return len(gone)


def _panel_query(spark: SparkSession, events_dir: str, root: str, window: str, delay: str, glob: str,
                 max_files_per_trigger: int | None):
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    updates = user_window_updates(logs_from_events(reader.parquet(events_dir)).feed, window, delay)
    return (
        updates.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(lambda df, batch_id: upsert_panel(df, batch_id, root))
    )


def run_today_panel(spark: SparkSession, events_dir: str, root: str | None = None, window: str = "1 hour",
                    delay: str = "10 minutes", glob: str = "events*.parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Bring the panel under ``root`` (default: a fresh shared folder) up to the files available now and return it."""
    root = root or shared_dir(spark, "today-panel")
    _panel_query(spark, events_dir, root, window, delay, glob, max_files_per_trigger) \
        .trigger(availableNow=True).start().awaitTermination()
    return read_today_panel(spark, root)


def start_today_panel(spark: SparkSession, events_dir: str, root: str, window: str = "1 hour",
                      delay: str = "10 minutes", every: str = "1 minute", glob: str = "events*.parquet"):
    """Keep the panel under ``root`` up to date with a micro-batch ``every``; returns the ``StreamingQuery``."""
    return _panel_query(spark, events_dir, root, window, delay, glob, None).trigger(processingTime=every).start()
