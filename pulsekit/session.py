"""Session construction and the shared folder used for lineage cuts and sinks."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should carry. AQE re-plans joins and
# shuffle partition counts at runtime (and splits skewed join partitions);
# UTC pins date/hour extraction so results do not depend on the host zone.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # operators checkpoint intermediate tables (ranks, A/A draws) into the shared
    # folder; remove those files once the checkpointed data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "pulsekit", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster pass the cluster master and a shuffle partition count sized so
    one partition stays well under executor memory (about 128-256 MB each).
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """Return a fresh sub-folder of the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` as configured on the
    session. Only when it is unset and the master is local do we create one; on
    a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="pulsekit-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    if name is None:
        return root
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
