"""One-scan roll-up for the multi-query trend job.

Queries 4, 5, 7, 8, 9, 10 and 12 group the same readings by subsets of
(zone, location, hour, day, date, class) and need only mergeable figures:
row and value counts, sum, sum of squares, min, max and threshold counts.
``readings_rollup`` computes those once at that finest grain (one scan, one
shuffle of partial rows); each query then re-aggregates the roll-up, which
is bounded by zones x locations x 24 x 7 x days x 6 rows whatever the
number of readings. Queries 3 and 11 need exact percentiles and the mode
reads classes, so they keep their direct form.

Sums are the exact ones of ``functions.exact``: whatever the split of the
readings and the order of merging, a figure comes out the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.functions import exact as fixed
from quietude.functions import expr as X
from quietude.functions.expr import E
from quietude.functions.expr import round_half_up_sql as R

ROLLUP_KEYS = ["geo_zone", "location_type", "hour", "day_of_week", "date", "noise_category"]
NOISE = "noise_level_db"


def readings_rollup(readings: DataFrame) -> DataFrame:
    """Mergeable figures per (zone, location, hour, day, date, class)."""
    x = NOISE
    return (readings.withColumn("date", E("to_date(`timestamp`)"))
            .groupBy(*ROLLUP_KEYS)
            .agg(*[E(a) for a in (
                "count(1) AS n_rows", *fixed.sums_sql(x),
                f"min({x}) AS mn", f"max({x}) AS mx", f"count_if({x} > 80.0D) AS n80",
                f"count_if({x} > 70.0D) AS n70", f"count_if({x} < 50.0D) AS n50")]))


_MERGED = tuple(m.rpartition(" AS ")[0] for m in fixed.merge_sql())
_MEAN = fixed.mean_sql(_MERGED)
_STD = fixed.std_sql(_MERGED)


def _stats5() -> list:
    return [E(a) for a in ("sum(n) AS measurement_count", f"{R(_MEAN)} AS avg_noise_db",
                           f"{R(_STD)} AS std_dev_db", f"{R('min(mn)')} AS min_noise_db",
                           f"{R('max(mx)')} AS max_noise_db")]


def zone_hotspots(r: DataFrame, min_count: int = 10, top: int = 20) -> DataFrame:
    return (r.groupBy("geo_zone")
            .agg(*[E(a) for a in ("sum(n_rows) AS measurement_count", f"{R(_MEAN)} AS avg_noise_db",
                                  f"{R('max(mx)')} AS max_noise_db", "sum(n80) AS extreme_noise_count",
                                  f"{R('100.0D * sum(n80) / sum(n_rows)')} AS extreme_noise_pct")])
            .filter(f"measurement_count >= {min_count}")
            .orderBy(F.desc("avg_noise_db"), "geo_zone").limit(top))


def weekday_weekend(r: DataFrame) -> DataFrame:
    return (r.filter("n > 0").groupBy(E(f"{X.day_type_sql('day_of_week')} AS period_type"))
            .agg(*_stats5()))


def peak_hours_by_location(r: DataFrame) -> DataFrame:
    return (r.filter("location_type IS NOT NULL AND location_type != '' AND n > 0")
            .groupBy("location_type", "hour")
            .agg(E(f"{R(_MEAN)} AS avg_noise_db"), E("sum(n) AS measurement_count"))
            .orderBy("location_type", F.desc("avg_noise_db"), "hour"))


def monthly_trends(r: DataFrame) -> DataFrame:
    return (r.filter("n > 0").groupBy(E("date_format(date, 'yyyy-MM') AS month"))
            .agg(*[E(a) for a in ("sum(n) AS measurement_count", f"{R(_MEAN)} AS avg_noise_db",
                                  f"{R(_STD)} AS std_dev_db", "sum(n70) AS high_noise_count")])
            .orderBy("month"))


def category_distribution(r: DataFrame) -> DataFrame:
    from quietude.operators.trends import with_share_of_total
    grouped = (r.filter("noise_category IS NOT NULL").groupBy("noise_category")
               .agg(*[E(a) for a in ("sum(n_rows) AS count", f"{R(_MEAN)} AS avg_noise_db",
                                     f"{R('min(mn)')} AS min_noise_db", f"{R('max(mx)')} AS max_noise_db")]))
    return (with_share_of_total(grouped, "count")
            .select("noise_category", "count", "percentage", "avg_noise_db", "min_noise_db", "max_noise_db")
            .orderBy(F.desc("count"), "noise_category"))


def zone_hour_day(r: DataFrame, min_count: int = 5, top: int = 100) -> DataFrame:
    return (r.filter("geo_zone IS NOT NULL AND n > 0").groupBy("geo_zone", "hour", "day_of_week")
            .agg(E("sum(n) AS sample_size"), E(f"{R(_MEAN)} AS avg_noise_db"), E(f"{R(_STD)} AS std_dev_db"))
            .filter(f"sample_size >= {min_count}")
            .orderBy(F.desc("avg_noise_db"), "geo_zone", "hour", "day_of_week").limit(top))


def export_aggregates(r: DataFrame) -> DataFrame:
    from quietude.operators.trends import SUMMARY_KEYS, export_figure_sql
    return (r.filter("n > 0").groupBy(*SUMMARY_KEYS)
            .agg(*[E(a) for a in (f"{export_figure_sql(_MEAN)} AS avg_noise_db", f"{export_figure_sql(_STD)} AS std_dev_db",
                                  "sum(n) AS sample_count", "max(mx) AS max_noise_db", "min(mn) AS min_noise_db")]))
