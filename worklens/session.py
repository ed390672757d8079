"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a split of a hot join partition is worth one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Shuffles start with so many partitions a core, at every size of session; adaptive execution merges
#: the small ones.
PARTITIONS_PER_CORE = 4
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings.

    The caller's session is changed: zone, adaptive execution and the number of partitions a shuffle
    starts with. A number of partitions set by whoever started the session stands.
    """
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    if not spark.conf.get(INITIAL_PARTITIONS, None):
        spark.conf.set(INITIAL_PARTITIONS, str(cores * PARTITIONS_PER_CORE))
    return spark


def shared_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for tables that one query writes and reads again.

    It lies in ``spark.checkpoint.dir``. Only where that is unset and all tasks run on this machine (a
    local master, as in tests) it is a temporary one; on a cluster that is an error.
    """
    local = spark.sparkContext.master.startswith("local")
    set_ = spark.conf.get("spark.checkpoint.dir", None)
    fallback = tempfile.mkdtemp(prefix="worklens-") if local and not set_ else None
    return f"{shared_folder(spark, fallback)}/scratch-{uuid4().hex}"
