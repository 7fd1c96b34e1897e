"""Spark session helpers.

Library functions never build their own session; they take DataFrames. These
helpers are for scripts, tests and the bench, and for the few jobs that need
a durable scratch location (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import SparkSession

# Settings every session gets. AQE re-plans at runtime (coalesces small
# shuffle partitions, splits skewed join partitions, switches joins to
# broadcast when a side turns out small).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "quietude",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    Without ``master`` the launcher decides (``spark-submit --master``, the
    defaults file, or Spark's own ``local[*]``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if (spark.sparkContext.master or "").startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, local_fallback: str | None = None) -> str:
    """Return the session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; when it is unset there, this raises instead of inventing a
    machine-local folder that other executors cannot see. Only local runs
    (tests, a laptop) get a fresh scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) "
                           "for jobs that checkpoint on a cluster")
    path = local_fallback or tempfile.mkdtemp(prefix="quietude-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cluster_settings(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    * Scan splits of 256 MB (fewer, larger tasks; Parquet row groups stay
      whole).
    * Shuffles start with enough partitions that a full-size shuffle stays
      near ``target_partition_bytes`` per task (at least 2x the cores). AQE then coalesces the many small partitions that
      partial aggregation leaves, so most jobs run far fewer.
    * Skewed joins split at 5x the median partition and 256 MB.

    Pass the result as ``extra`` to ``get_session`` (or as ``--conf``).
    """
    initial = max(2 * total_cores, math.ceil(input_bytes / target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }
