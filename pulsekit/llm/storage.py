"""Intermediate tables in the shared folder of the session (``spark.checkpoint.dir``).

A written table cuts lineage, survives lost executors and gives the planner a
known size, so a join broadcasts it only under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsekit.session import shared_dir


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh shared folder and read it back."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.saved_path = path
    return table


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove saved tables that nothing still to be computed reads: what came of them is saved itself."""
    for table in tables:
        at = spark._jvm.org.apache.hadoop.fs.Path(table.saved_path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
