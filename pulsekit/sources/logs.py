"""Readers for the feed and message logs, and the adapter from raw ``events``.

Production input is two append-only logs (``feed_actions``, ``message_actions``)
read with a declared schema so column pruning and filter pushdown reach the
Parquet scan. For tests and benchmarks the logs are derived from the driver's
``events`` table by a fixed, purely columnar mapping (no shuffle): the adapter
is a projection + filter that Catalyst fuses into the scan stage.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.sources.schemas import EVENTS_SCHEMA, FEED_SCHEMA, MESSAGE_SCHEMA


@dataclass(frozen=True)
class EventLogs:
    feed: DataFrame
    messages: DataFrame


def read_log(spark: SparkSession, source: str, schema: T.StructType, format: str = "parquet",
             date_partition: str | None = None, days: tuple[date, date] | None = None,
             **options) -> DataFrame:
    """Read a log from files, a (possibly namespaced) catalog table, or JDBC.

    * ``source`` containing '/' is a path read with ``format`` (parquet, orc,
      csv, json, ...) and the declared schema (no inference);
    * ``format="jdbc"`` reads ``source`` as the table name through the given
      connection ``options`` (url, user, ..., partitionColumn/lowerBound/
      upperBound/numPartitions for a parallel read); the JDBC driver must be
      on the classpath;
    * otherwise ``source`` is a catalog table such as ``analytics.feed_actions``.

    Columns are selected by name and cast to the declared types, so a wider
    or reordered source still yields the contract. For logs stored
    partitioned by a date column, ``date_partition`` and ``days`` (first,
    last) restrict the read to those partitions (partition pruning; filters
    on ``time`` alone cannot prune partitions).
    """
    if format == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=source, **options).load()
    elif "/" in source and date_partition:  # partition column discovered from the folder names
        df = spark.read.format(format).options(**options).load(source)
    elif "/" in source:
        reader = spark.read.format(format).schema(schema)
        if format == "csv":
            reader = reader.option("header", "true")
        df = reader.options(**options).load(source)
    else:
        df = spark.table(source)
    if date_partition and days:
        df = df.where(F.col(date_partition).between(F.lit(days[0]), F.lit(days[1])))
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{source} lacks columns {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# Fixed values of the fixture mapping from ``events`` to the two logs (every event is a row of one of them):
#   account          user_id from the day 2024-01-01 + (user_id * 11) % 28 on; earlier events
#                    belong to the user's previous account, user_id + 10,000,000
#   post id          props.k, receiver id props.k
#   gender           account % 2;  age 13 + (account * 7) % 60
#   os               'iOS' when event_id % 3 = 0 else 'Android'
#   source           account % 10 = 9: 'ads' for even event_id else 'organic';
#                    otherwise 'ads' when account % 3 = 0 else 'organic'
#   city             'city_' || account % 6;  exp_group account % 4
#   log              account % 5 = 3: all rows to the feed; else account % 7 = 0: all rows to the
#                    messages; else purchase and error are messages, the rest feed actions
#   action           click, purchase -> 'like'; the rest -> 'view'
FIXTURE_EPOCH = date(2024, 1, 1)
PREVIOUS_ACCOUNT = 10_000_000


def _fixture_base(events: DataFrame) -> DataFrame:
    raw, uid, eid = F.col("user_id"), F.col("account"), F.col("event_id")
    activation = F.date_add(F.lit(FIXTURE_EPOCH), ((raw * 11) % 28).cast("int"))
    source: Column = (
        F.when(uid % 10 == 9, F.when(eid % 2 == 0, "ads").otherwise("organic"))
        .when(uid % 3 == 0, "ads")
        .otherwise("organic")
    )
    to_feed = (
        F.when(uid % 5 == 3, True).when(uid % 7 == 0, False)
        .otherwise(F.coalesce(~F.col("event_type").isin("purchase", "error"), F.lit(True)))
    )
    return (
        events.withColumn(
            "account", F.when(F.col("ts") >= activation.cast("timestamp_ntz"), raw).otherwise(raw + PREVIOUS_ACCOUNT))
        .select(
            uid.alias("user_id"),
            F.when(F.col("event_type").isin("click", "purchase"), "like").otherwise("view").alias("action"),
            to_feed.alias("to_feed"),
            F.col("ts").alias("time"),
            F.get_json_object("props", "$.k").try_cast("int").alias("k"),
            (uid % 2).cast("int").alias("gender"),
            (13 + (uid * 7) % 60).cast("int").alias("age"),
            F.when(eid % 3 == 0, "iOS").otherwise("Android").alias("os"),
            source.alias("source"),
            F.concat(F.lit("city_"), (uid % 6).cast("string")).alias("city"),
            (uid % 4).cast("int").alias("exp_group"),
        )
    )


def logs_from_events(events: DataFrame) -> EventLogs:
    """Map the raw events table onto the feed and message logs (see fixed values above)."""
    base = _fixture_base(events)
    feed = base.where("to_feed").select(
        "user_id", F.col("k").alias("post_id"), "action",
        "time", "gender", "age", "os", "source", "city", "exp_group",
    )
    messages = base.where("not to_feed").select(
        "user_id",
        F.col("k").cast("bigint").alias("reciever_id"),
        "time", "gender", "age", "os", "source",
    )
    return EventLogs(feed=feed, messages=messages)


def load_fixture_logs(spark: SparkSession, sf_dir: str) -> EventLogs:
    """Feed and message logs derived from ``{sf_dir}/events.parquet``."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return logs_from_events(events)


__all__ = ["EventLogs", "read_log", "logs_from_events", "load_fixture_logs",
           "FEED_SCHEMA", "MESSAGE_SCHEMA"]
