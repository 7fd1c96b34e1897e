"""Explicit schemas (no inference on large inputs)."""

from pyspark.sql import types as T

# Raw sensor CSV, the columns the feature job reads.
RAW_SENSOR_COLUMNS = [
    "time", "id_participant", "ws_latitude", "ws_longitude", "q_location",
    "q_noise_kind", "q_noise_nearby", "ts_audio_exposure_environment", "ts_heart_rate",
]

RAW_SENSOR_SCHEMA = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("id_participant", T.StringType()),
    T.StructField("ws_latitude", T.DoubleType()),
    T.StructField("ws_longitude", T.DoubleType()),
    T.StructField("q_location", T.StringType()),
    T.StructField("q_noise_kind", T.StringType()),
    T.StructField("q_noise_nearby", T.StringType()),
    T.StructField("ts_audio_exposure_environment", T.DoubleType()),
    T.StructField("ts_heart_rate", T.DoubleType()),
])

# The eleven exported reading columns, in export order, with table names.
READING_COLUMNS = [
    "timestamp", "participant_id", "latitude", "longitude", "noise_level_db",
    "noise_category", "location_type", "noise_kind", "hour", "day_of_week", "geo_zone",
]

# Export (TSV) header names for the same eleven columns.
EXPORT_HEADER = [
    "time", "id_participant", "ws_latitude", "ws_longitude", "noise_level_db",
    "noise_category", "q_location", "q_noise_kind", "hour", "day_of_week", "geo_zone",
]

READINGS_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("participant_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("noise_level_db", T.DoubleType()),
    T.StructField("noise_category", T.StringType()),
    T.StructField("location_type", T.StringType()),
    T.StructField("noise_kind", T.StringType()),
    T.StructField("hour", T.LongType()),
    T.StructField("day_of_week", T.LongType()),
    T.StructField("geo_zone", T.StringType()),
])

# Readings table as text on disk: every field a string, typed on parse.
READINGS_TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in EXPORT_HEADER])

ZONE_STATISTICS_SCHEMA = T.StructType([
    T.StructField("geo_zone", T.StringType()),
    T.StructField("avg_noise_db", T.DoubleType()),
    T.StructField("max_noise_db", T.DoubleType()),
    T.StructField("min_noise_db", T.DoubleType()),
    T.StructField("std_dev_db", T.DoubleType()),
    T.StructField("sample_count", T.LongType()),
    T.StructField("last_updated", T.StringType()),
])

HOURLY_TRENDS_SCHEMA = T.StructType([
    T.StructField("hour", T.LongType()),
    T.StructField("avg_noise_db", T.DoubleType()),
    T.StructField("sample_count", T.LongType()),
    T.StructField("max_noise_db", T.DoubleType()),
])

# Driver tables the jobs read (FIXTURES.md section 8). Declaring them skips
# footer-based schema discovery on the driver and fixes the read types up
# front, whatever the files hold.
DRIVER_TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
              "props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}
