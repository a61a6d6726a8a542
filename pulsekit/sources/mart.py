"""Sink for the long-form metrics mart.

The reference appends a day to its table with retries, so a retried load can
duplicate a day. Here a load replaces exactly the ``event_date`` partitions it
carries (dynamic partition overwrite), which makes reruns and backfills
idempotent, and partitioning by date gives partition pruning on read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.sources.manifest import list_names, publish, read_manifest, remove
from pulsekit.sources.schemas import MART_SCHEMA


def write_mart(mart: DataFrame, path: str) -> None:
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in MART_SCHEMA.fields]
    (
        mart.select(cols)
        .repartition("event_date")  # one writer per day: one file per partition
        .sortWithinPartitions("dimension", "dimension_value")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(MART_SCHEMA).parquet(path)
    return df.select([f.name for f in MART_SCHEMA.fields])


def publish_mart(spark: SparkSession, mart: DataFrame, path: str) -> list[str]:
    """Load the days of ``mart`` so that readers see a day either before or after the load.

    The load is written to a folder of its own; then one manifest puts all its
    days into force at once. A load that dies on the way, or is run again, leaves
    the days in force as they are; its folder is unreachable and goes with ``clean_mart``.
    Returns the days loaded.
    """
    load = f"load={uuid.uuid4().hex}"
    write_mart(mart, f"{path}/data/{load}")
    days = [n for n in list_names(spark, f"{path}/data/{load}") if n.startswith("event_date=")]
    if days:
        publish(spark, path, {d.partition("=")[2]: f"data/{load}/{d}" for d in days})
    return [d.partition("=")[2] for d in days]


def read_published_mart(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The days in force, from ``first`` to ``last`` (ISO dates, inclusive): only their folders are read."""
    folders = [f"{path}/{at}" for day, at in sorted(read_manifest(spark, path).items())
               if (first is None or day >= first) and (last is None or day <= last)]
    if not folders:
        return spark.createDataFrame([], MART_SCHEMA)
    df = spark.read.schema(MART_SCHEMA).option("basePath", f"{path}/data").parquet(*folders)
    return df.select([f.name for f in MART_SCHEMA.fields])


def clean_mart(spark: SparkSession, path: str) -> int:
    """Remove loads that hold no day in force (run it when no load is under way)."""
    live = {at.split("/")[1] for at in read_manifest(spark, path).values()}
    gone = [n for n in list_names(spark, f"{path}/data") if n not in live]
    for name in gone:
        remove(spark, f"{path}/data/{name}")
    return len(gone)


def mart_table_ddl(table: str) -> str:
    cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in MART_SCHEMA.fields
                     if f.name != "event_date")
    return f"CREATE TABLE IF NOT EXISTS {table} ({cols}, event_date DATE) USING parquet PARTITIONED BY (event_date)"


def write_mart_table(spark: SparkSession, mart: DataFrame, table: str) -> None:
    """Load into a catalog table, creating it if absent (the reference's DDL +
    insert), replacing only the days being loaded."""
    spark.sql(mart_table_ddl(table))
    ordered = [F.col(f.name).cast(f.dataType) for f in MART_SCHEMA.fields if f.name != "event_date"]
    key = "spark.sql.sources.partitionOverwriteMode"
    previous = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")  # insertInto ignores the writer option; the session setting governs
    try:
        (
            mart.select(*ordered, F.col("event_date").cast("date"))
            .repartition("event_date")
            .write.insertInto(table, overwrite=True)
        )
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def read_mart_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select([f.name for f in MART_SCHEMA.fields])
