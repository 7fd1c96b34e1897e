"""Sinks: key/value text, TSV/CSV exports, partitioned Parquet, directory
export, appends, keyed upserts, JSON Lines, the nested JSON report, views and
create-if-absent tables.

Every writer is a distributed Spark write (one file per task); nothing is
gathered on the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietude.operators import features

# Local wall-clock time with full microseconds (the CSV default keeps millis).
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# Which side of an upsert a row is from.
_BATCH = "_upsert_batch"


def write_key_value_text(df: DataFrame, path: str, key: str, value: str,
                         mode: str = "errorifexists") -> None:
    """``key<TAB>value`` lines; fails if the folder exists (K1)."""
    df.select(F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string")).alias("value")) \
        .write.mode(mode).text(path)


def export_readings_tsv(readings: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """The eleven reading columns as TSV with a header (K2)."""
    out = features.export_columns(readings)
    (out.write.mode(mode)
     .options(sep="\t", header=True, escape='"', timestampNTZFormat=TS_FORMAT)
     .csv(path))
    return out


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header (K3)."""
    df.write.mode(mode).options(header=True, escape='"').csv(path)


def write_stats_tsv(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Key statistics as TSV sorted by key, header
    ``key count mean_db std_dev min_db max_db`` (K4). Written in key order
    (range-partitioned sort), not through one task."""
    (stats.select("key", "count", "mean_db", "std_dev", "min_db", "max_db")
     .orderBy("key")
     .write.mode(mode).options(sep="\t", header=True).csv(path))


def insert_overwrite_directory(spark: SparkSession, query_view: str, path: str) -> None:
    """``INSERT OVERWRITE DIRECTORY ... USING csv`` of a view (K5)."""
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING csv "
              f"OPTIONS (sep ',') SELECT * FROM {query_view}")


def write_partitioned_parquet(df: DataFrame, path: str, partition_col: str = "date_partition",
                              mode: str = "overwrite", dynamic: bool = True) -> None:
    """Parquet partitioned by ``partition_col`` (K6); dynamic partition
    overwrite replaces only the partitions present in ``df`` (without
    ``dynamic``, the whole folder).

    Rows are range-partitioned on (partition value, row hash): each task
    writes few partition folders, and a partition value holding a large
    share of the rows is split over several tasks instead of one. The hash
    is deterministic, so a retried task writes the same rows."""
    hashable = [f.name for f in df.schema.fields
                if f.dataType.typeName() not in ("map",) and f.name != partition_col]
    (df.repartitionByRange(F.col(partition_col), F.xxhash64(*[F.col(c) for c in hashable]))
     .write.mode(mode)
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(partition_col)
     .parquet(path))


HOURLY_STATS_DDL = ("geo_zone STRING, hour BIGINT, avg_noise_db DOUBLE, max_noise_db DOUBLE, "
                    "min_noise_db DOUBLE, std_dev_db DOUBLE, sample_count BIGINT, "
                    "noise_category_distribution MAP<STRING, BIGINT>, date_partition STRING")


def insert_into_table(df: DataFrame, name: str, overwrite: bool = True) -> None:
    """Insert into a catalog table by column position, replacing only the
    partitions present in ``df`` (dynamic partition overwrite) (K6 with
    K12: declare the table once, then load it)."""
    table_cols = df.sparkSession.table(name).columns
    (df.select(*table_cols)
     .write.option("partitionOverwriteMode", "dynamic")
     .insertInto(name, overwrite=overwrite))


def append_table(df: DataFrame, path: str) -> None:
    """Append rows (K7). Each write job commits atomically; rerunning a load
    appends its rows again, as a plain append does (``write_load`` does not)."""
    df.write.mode("append").parquet(path)


def _filesystem(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _load_folder(path: str, load_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", load_id):
        raise ValueError(f"a load id is letters, digits, dots, dashes: {load_id!r}")
    return f"{path.rstrip('/')}/load_id={load_id}"


def write_load(df: DataFrame, path: str, load_id: str, partition_col: str | None = None) -> None:
    """Append the rows of one load to the table at ``path`` (K7), so that a load
    that is run again replaces itself.

    A load has a folder of its own, ``load_id=...``. It is written under a name
    that readers ignore and then takes its place: a load that fails leaves the
    table as it was, and other loads' files are never touched. A run stopped
    after the old folder went is mended by the next run of that load."""
    spark = df.sparkSession
    target, fs = _filesystem(spark, _load_folder(path, load_id))
    fresh, _ = _filesystem(spark, f"{path.rstrip('/')}/_loading-{load_id}")
    if partition_col is None:
        df.write.mode("overwrite").parquet(fresh.toString())
    else:
        write_partitioned_parquet(df, fresh.toString(), partition_col, dynamic=False)
    fs.delete(target, True)
    if not fs.rename(fresh, target):
        raise OSError(f"cannot rename {fresh.toString()} to {target.toString()}")


def load_partitions(spark: SparkSession, path: str, load_id: str | None = None) -> set[str]:
    """The partition values that a load has (none if there is no such load), or
    that any load has."""
    folder = _load_folder(path, load_id) if load_id else f"{path.rstrip('/')}/load_id=*"
    pattern, fs = _filesystem(spark, f"{folder}/*=*")
    found = fs.globStatus(pattern) or []
    return {f.getPath().getName().partition("=")[2] for f in found}


def drop_partitions(spark: SparkSession, path: str, partition_col: str, values: set[str]) -> None:
    """Remove whole partitions of a Parquet table."""
    for value in values:
        folder, fs = _filesystem(spark, f"{path.rstrip('/')}/{partition_col}={value}")
        fs.delete(folder, True)


def _one_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by ``order``, then by its other values
    (maps have no order). One aggregate, partially done before the shuffle."""
    cols = [c for c in rows.columns if c != _BATCH]
    rest = [c for c in cols if c not in keys]
    if not rest:
        return rows.select(*cols).distinct()
    ranked = [f.name for f in rows.schema.fields if f.name in rest and "map<" not in f.dataType.simpleString()]
    last = F.max_by(F.struct(*rest), F.struct(_BATCH, *order, *ranked))
    return rows.groupBy(*keys).agg(last.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in cols])


def upsert(old: DataFrame | None, new: DataFrame, key: list[str] | str,
           order: list[str] | str = ()) -> DataFrame:
    """Keyed upsert as a DataFrame (K8): a row of ``new`` replaces the row of
    ``old`` with the same key; other old rows stay. The result has one row per
    key: of several rows of ``new`` with one key the last by ``order`` stays.
    Applying it twice with the same ``new`` gives the same table."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = new.withColumn(_BATCH, F.lit(1))
    if old is not None:
        rows = old.withColumn(_BATCH, F.lit(0)).unionByName(rows, allowMissingColumns=True)
    return _one_per_key(rows, keys, [order] if isinstance(order, str) else list(order))


def upsert_table(spark: SparkSession, path: str, new: DataFrame, key: list[str] | str,
                 order: list[str] | str = ()) -> DataFrame:
    """Upsert ``new`` into the Parquet table at ``path`` (K8).

    The merged rows are written beside the table and then take its place by
    rename, so a failed write leaves the table as it was, and a run stopped
    between the two renames is mended by the next one. Only a missing path
    counts as no table; an unreadable one is an error.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    previous, fresh = target.suffix("__previous"), target.suffix("__next")

    def rename(a, b) -> None:
        if not fs.rename(a, b):
            raise OSError(f"cannot rename {a.toString()} to {b.toString()}")

    if not fs.exists(target) and fs.exists(previous):
        rename(previous, target)
    old = spark.read.parquet(path) if fs.exists(target) else None
    upsert(old, new, key, order).write.mode("overwrite").parquet(fresh.toString())
    if old is not None:
        fs.delete(previous, True)
        rename(target, previous)
    rename(fresh, target)
    fs.delete(previous, True)
    return spark.read.parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row, NULL fields written as ``null`` (K9)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_report_json(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row nested report as JSON (K10); integer map keys become text."""
    report.coalesce(1).write.mode(mode).json(path)


def create_view(spark: SparkSession, name: str, df: DataFrame) -> None:
    """View of this session over any DataFrame."""
    df.createOrReplaceTempView(name)


def create_persistent_view(spark: SparkSession, name: str, query: str) -> None:
    """``CREATE VIEW IF NOT EXISTS`` over catalog tables (K11): kept in the
    catalog, so other sessions read it by name."""
    spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS {query}")


def create_table_if_absent(spark: SparkSession, name: str, schema_ddl: str,
                           using: str = "parquet", partitioned_by: str | None = None,
                           location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS``."""
    part = f" PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING {using}{part}{loc}")


__all__ = [
    "write_key_value_text", "export_readings_tsv", "write_csv", "write_stats_tsv",
    "insert_overwrite_directory", "write_partitioned_parquet", "append_table", "write_load", "load_partitions", "upsert",
    "upsert_table", "write_json_lines", "write_report_json", "create_view",
    "create_persistent_view",
    "create_table_if_absent", "insert_into_table", "HOURLY_STATS_DDL",
]
