"""Scans: driver tables, text lines, CSV / TSV files and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietude.sources.schemas import DRIVER_TABLE_SCHEMAS, RAW_SENSOR_SCHEMA, READINGS_TEXT_SCHEMA

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet), with its declared schema when known.
    Column pruning and filters reach the scan."""
    reader = spark.read
    if name in DRIVER_TABLE_SCHEMAS:
        reader = reader.schema(DRIVER_TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text line scan: one row per line, column ``value``."""
    return spark.read.text(path)


def document_lines(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Every line of every document as a ``value`` row (whole texts, all lines)."""
    return documents.select(F.explode(F.split(F.col(text_col), "\n")).alias("value"))


def raw_sensor_csv(spark: SparkSession, path: str, extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """Raw sensor CSV with a header: the nine used columns picked by name
    (the file has many more, in any order) and typed explicitly; ``extra_cols``
    are kept as DOUBLE (for example a base noise estimate). Reading every
    field as text avoids an inference pass; ``""`` is unescaped. A value that
    does not parse becomes NULL; ``sources.raw`` tells which did."""
    raw = spark.read.options(header=True, escape='"', mode="PERMISSIVE").csv(path)
    cols = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in RAW_SENSOR_SCHEMA.fields]
    cols += [F.col(f"`{c}`").try_cast("double").alias(c) for c in extra_cols]
    return raw.select(*cols)


def readings_tsv_as_text(spark: SparkSession, path: str) -> DataFrame:
    """Exported readings TSV, every field a string (typed by ``parse``)."""
    return (spark.read.schema(READINGS_TEXT_SCHEMA)
            .options(header=True, sep="\t", escape='"')
            .csv(path))


def create_readings_table(spark: SparkSession, name: str, location: str) -> None:
    """External TSV table over an export folder (header line skipped)."""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
            timestamp STRING, participant_id STRING, latitude DOUBLE, longitude DOUBLE,
            noise_level_db DOUBLE, noise_category STRING, location_type STRING,
            noise_kind STRING, hour INT, day_of_week INT, geo_zone STRING)
        USING csv OPTIONS (header 'true', sep '\\t')
        LOCATION '{location}'
    """)


def stored(spark: SparkSession, path_or_table: str) -> DataFrame:
    """Read back a stored table by name or parquet path."""
    if "/" in path_or_table:
        return spark.read.parquet(path_or_table)
    return spark.table(path_or_table)
