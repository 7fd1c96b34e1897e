"""Incremental loads with Structured Streaming.

The reference imports readings in batches (append) and recomputes keyed
statistics from mergeable partials (count, sum, min, max, sum of squares).
Streaming gives both incrementally:

* ``append_readings``: exactly-once append of arriving reading files into a
  Parquet table (file sink + checkpoint).
* ``moments_by_batch``: each micro-batch's partial moments per composite
  key, written to its own ``batch_id`` partition. A replayed batch
  overwrites only its own partition, so a retry never double-counts.
* ``merged_moments``: the current statistics = merge of all stored
  partials (same result as one pass over all rows).
* ``compact_partials``: folds many per-batch partitions into one partial
  row per key (written to a new folder), keeping later merges cheap.

Geographic zones need global bounds, so the stream reads readings that are
already zoned (for example an exported readings table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quietude.functions.expr import E
from quietude.functions import exact as fixed
from quietude.operators import stats
from quietude.sources.schemas import READINGS_SCHEMA


def read_readings_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Readings Parquet files arriving under ``path`` as a stream."""
    reader = spark.readStream.schema(READINGS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def append_readings(stream: DataFrame, table_path: str, checkpoint: str,
                    available_now: bool = True) -> StreamingQuery:
    """Append every arriving reading to ``table_path`` exactly once (K7)."""
    w = stream.writeStream.format("parquet").option("path", table_path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _compacted(spark: SparkSession, table_path: str) -> int:
    """The last batch folded into the history of ``table_path``; -1 if none."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(table_path, "batch_id=-*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    ids = [int(f.getPath().getName().partition("=")[2]) for f in found or []]
    return max([-1 - i for i in ids], default=-1)


def _write_batch_partials(table_path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= _compacted(batch.sparkSession, table_path):
            return  # a replay of a batch that the history holds
        partials = stats.moments_partial(batch, split_cols=()).selectExpr("*", f"{batch_id}L AS batch_id")
        (partials.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id")
         .parquet(table_path))
    return write


def moments_by_batch(stream: DataFrame, table_path: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Store each micro-batch's partial moments per composite key (A4)."""
    w = stream.writeStream.foreachBatch(_write_batch_partials(table_path)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def merged_moments(spark: SparkSession, table_path: str) -> DataFrame:
    """Current keyed statistics from all stored partials (A5)."""
    return stats.moments_merge(spark.read.parquet(table_path).drop("batch_id"))


def compact_partials(spark: SparkSession, table_path: str, out_path: str) -> DataFrame:
    """Fold all per-batch partials into one row per key under ``out_path``
    (a new folder; the source stays intact until the caller switches).
    Sums add, minima and maxima combine. The history of batches up to N gets the
    id -1 - N, which no batch has: later batches are added next to it, and a
    replay of one that it holds is skipped."""
    parts = spark.read.parquet(table_path)
    history = parts.agg(E("least(-1 - max(batch_id), min(batch_id))")).scalar()
    folded = parts.groupBy("key").agg(*[E(a) for a in (
        *fixed.merge_sql(), "min(min_x) AS min_x", "max(max_x) AS max_x")]).withColumn("batch_id", history)
    folded.write.mode("overwrite").partitionBy("batch_id").parquet(out_path)
    return spark.read.parquet(out_path)
