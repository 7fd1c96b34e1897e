"""A dashboard and an hourly table that are kept, not recomputed.

A load stores only its own partials: how often each value occurs per group and
day, or the exact sums and the class map per zone, hour and day. Whatever is
shown is merged from the partials of all loads; the readings are not read
again. A load that is repeated replaces its own partials (``write_load``), so
nothing counts twice, and no other load's files are touched.

A histogram has a row per distinct value, group and day: readings of two
decimals make at most some thousands, however many there are. Values that
never repeat make it as long as the readings; it is still spread over all
groups and merged by sorting, not in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietude.functions import exact as fixed
from quietude.functions import expr as X
from quietude.functions.expr import E
from quietude.functions.expr import round_half_up_sql as R
from quietude.operators.trends import NOISE, SUMMARY_KEYS
from quietude.sinks import writers as W

HISTOGRAM_SCHEMA = ("geo_zone STRING, location_type STRING, hour BIGINT, day_of_week BIGINT, value DOUBLE, n BIGINT, "
                    "load_id STRING, date DATE")
HOURLY_KEYS = ["geo_zone", "hour", "date_partition"]
CLASS_MAP = "noise_category_distribution"


# --- the dashboard -----------------------------------------------------------

def day_histograms(readings: DataFrame) -> DataFrame:
    """How often each noise value occurs per summary group and day."""
    return (readings.filter(f"{NOISE} IS NOT NULL")
            .groupBy(*SUMMARY_KEYS, E(f"{NOISE} AS value"), E("to_date(`timestamp`) AS date")).agg(E("count(1) AS n")))


def load_histograms(readings: DataFrame, path: str, load_id: str) -> None:
    """Store one load's histograms, by day."""
    W.write_load(day_histograms(readings), path, load_id, "date")


def histograms(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTOGRAM_SCHEMA).parquet(path)


def summary_sql(source: str) -> str:
    """Query 11 over stored histograms (columns of HISTOGRAM_SCHEMA) as SQL text.

    Histograms of a group add up; the median is where the running count
    passes the middle."""
    keys = ", ".join(SUMMARY_KEYS)
    middle = "(total - 1) * 0.5D"
    return f"""
        WITH merged AS (SELECT {keys}, value, CAST(sum(n) AS BIGINT) AS n FROM {source} GROUP BY {keys}, value),
        running AS (
            SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY value) AS upto, sum(n) OVER (PARTITION BY {keys}) AS total
            FROM merged),
        sums AS (
            SELECT {keys}, {', '.join(fixed.sums_sql('value', 'n'))}, min(value) AS lowest, max(value) AS highest,
                   min(value) FILTER (WHERE upto > floor({middle})) AS below, min(value) FILTER (WHERE upto > ceil({middle})) AS above,
                   coalesce(sum(n) FILTER (WHERE value > 80.0D), 0L) AS extreme, coalesce(sum(n) FILTER (WHERE value < 50.0D), 0L) AS quiet
            FROM running GROUP BY {keys})
        SELECT {keys}, {X.day_type_sql('day_of_week')} AS day_type, n AS total_measurements,
               {R(fixed.mean_sql())} AS avg_noise_db, {R(fixed.std_sql())} AS std_dev_db,
               {R('lowest')} AS min_noise_db, {R('highest')} AS max_noise_db, {R('0.5D * below + 0.5D * above')} AS median_noise_db,
               extreme AS extreme_noise_events, quiet AS quiet_events
        FROM sums"""


def kept_summary(hist: DataFrame) -> DataFrame:
    """The dashboard from stored histograms."""
    return hist.sparkSession.sql(summary_sql("{hist}"), hist=hist)


def create_dashboard(spark: SparkSession, name: str, path: str) -> None:
    """A persistent view over the histograms at ``path``: always of all loads
    that are there when it is read."""
    W.create_persistent_view(spark, name, summary_sql(f"parquet.`{path}`"))


# --- the hourly table --------------------------------------------------------

def merge_counts_sql(col: str, labels: list[str]) -> str:
    """Aggregate that adds up MAP<label, count> columns over a closed set of
    labels; labels without a count are left out."""
    pairs = ", ".join(f"{X.s(label)}, coalesce(sum(element_at({col}, {X.s(label)})), 0L)" for label in labels)
    return f"map_filter(map({pairs}), (k, v) -> v > 0)"


def hourly_partials(readings: DataFrame) -> DataFrame:
    """Exact sums, extremes and class map per zone, hour and day."""
    return (readings.filter(f"{NOISE} IS NOT NULL")
            .groupBy("geo_zone", "hour", E("date_format(`timestamp`, 'yyyy-MM-dd') AS date_partition"))
            .agg(*[E(a) for a in (*fixed.sums_sql(NOISE), f"min({NOISE}) AS lowest", f"max({NOISE}) AS highest",
                                  f"{merge_counts_sql('map(noise_category, 1L)', X.ALL_NOISE_CLASSES)} AS {CLASS_MAP}")]))


def merged_hourly(partials: DataFrame) -> DataFrame:
    """The hourly table (as ``trends.zone_hourly_stats``) from partials of any loads."""
    merged = partials.groupBy(*HOURLY_KEYS).agg(*[E(a) for a in (
        *fixed.merge_sql(), "min(lowest) AS lowest", "max(highest) AS highest",
        f"{merge_counts_sql(CLASS_MAP, X.ALL_NOISE_CLASSES)} AS {CLASS_MAP}")])
    return merged.selectExpr("geo_zone", "hour", f"{R(fixed.mean_sql())} AS avg_noise_db", f"{R('highest')} AS max_noise_db",
                             f"{R('lowest')} AS min_noise_db", f"{R(fixed.std_sql())} AS std_dev_db", "n AS sample_count",
                             CLASS_MAP, "date_partition")


def load_hourly(readings: DataFrame, partials_path: str, table_path: str, load_id: str) -> list[str]:
    """Store a load's partials and bring the days it touches up to date in the
    hourly table; other days keep their files. Gives the days.

    Days that an earlier run of the same load had and this one has not are
    among them."""
    spark = readings.sparkSession
    partials = hourly_partials(readings)
    schema = "geo_zone STRING, hour BIGINT, n BIGINT, s DECIMAL(38,0), q_hi DECIMAL(38,0), q_lo DECIMAL(38,0), lowest DOUBLE, " \
             f"highest DOUBLE, {CLASS_MAP} MAP<STRING, BIGINT>, load_id STRING, date_partition STRING"
    before = W.load_partitions(spark, partials_path, load_id)
    W.write_load(partials, partials_path, load_id, "date_partition")
    days = sorted(before | W.load_partitions(spark, partials_path, load_id))
    stored = spark.read.schema(schema).parquet(partials_path)
    W.write_partitioned_parquet(merged_hourly(stored.filter(F.col("date_partition").isin(days))), table_path)
    W.drop_partitions(spark, table_path, "date_partition", before - W.load_partitions(spark, partials_path))
    return days
