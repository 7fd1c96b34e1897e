"""Multi-grain trend queries over readings (hourly, hotspots, weekday/weekend,
location, peak hours, monthly, category shares, zone x hour x day, dashboard
summary, export roll-up, hourly zone statistics with a category map).

All aggregates are algebraic or bounded-buffer (``mode`` keeps one count per
class, percentiles come from ``ranks``), so every ``groupBy`` runs with a
map-side partial aggregate: a hot key (one zone holding a third of the rows)
sends one partial row per task, not its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quietude.functions import exact as fixed
from quietude.functions import expr as X
from quietude.functions.expr import E, q
from quietude.functions.expr import round_half_up_sql as R
from quietude.operators import ranks

NOISE = "noise_level_db"


def _aggs(*sql: str):
    return [E(x) for x in sql]


def _stats5(x: str = NOISE) -> list[str]:
    return [f"count(1) AS measurement_count",
            f"{R(f'avg({x})')} AS avg_noise_db",
            f"{R(f'stddev_pop({x})')} AS std_dev_db",
            f"{R(f'min({x})')} AS min_noise_db",
            f"{R(f'max({x})')} AS max_noise_db"]


def hourly_trends(readings: DataFrame, exact: bool = True) -> DataFrame:
    """Query 3: per hour count, avg, population std, min, max, median, p95.

    Percentiles are exact by rank selection (``ranks``: a few scans, bounded
    state); ``exact=False`` takes ``percentile_approx`` in the one scan."""
    rows, probs = readings.filter(f"{NOISE} IS NOT NULL"), {"median_noise_db": 0.5, "p95_noise_db": 0.95}
    return _with_percentiles(rows, ["hour"], _stats5(), probs, exact).orderBy("hour")


def _with_percentiles(rows: DataFrame, keys: list[str], aggs: list[str], probs: dict[str, float], exact: bool,
                      digits: int = 2) -> DataFrame:
    """Aggregates and rounded percentiles of the noise by ``keys``."""
    if exact:
        out = ranks.with_percentiles(rows, keys, NOISE, aggs, probs)
    else:
        approx = [f"percentile_approx({NOISE}, {X.dbl(p)}, 10000) AS {name}" for name, p in probs.items()]
        out = rows.groupBy(*keys).agg(*_aggs(*aggs, *approx))
    return out.withColumns({name: E(R(name, digits)) for name in probs})


def zone_hotspots(readings: DataFrame, min_count: int = 10, top: int = 20,
                  extreme_db: float = 80.0) -> DataFrame:
    """Query 4: zones by average noise with the share above ``extreme_db``,
    at least ``min_count`` rows, top ``top`` (A7, A33, A34, O4)."""
    extreme = f"count_if({NOISE} > {X.dbl(extreme_db)})"
    return (readings.filter("geo_zone IS NOT NULL")
            .groupBy("geo_zone")
            .agg(*_aggs("count(1) AS measurement_count",
                        f"{R(f'avg({NOISE})')} AS avg_noise_db",
                        f"{R(f'max({NOISE})')} AS max_noise_db",
                        f"{extreme} AS extreme_noise_count",
                        f"{R(f'100.0D * {extreme} / count(1)')} AS extreme_noise_pct"))
            .filter(f"measurement_count >= {min_count}")
            .orderBy(F.desc("avg_noise_db"), "geo_zone")
            .limit(top))


def weekday_weekend(readings: DataFrame) -> DataFrame:
    """Query 5: weekday vs weekend."""
    return (readings.filter(f"{NOISE} IS NOT NULL")
            .groupBy(E(f"{X.day_type_sql('day_of_week')} AS period_type"))
            .agg(*_aggs(*_stats5())))


_HAS_LOCATION = "location_type IS NOT NULL AND location_type != ''"


def location_analysis(readings: DataFrame) -> DataFrame:
    """Query 6: per location stats plus the most common noise class.

    ``mode(..., true)`` breaks ties to the lowest label and keeps a bounded
    per-group buffer (one count per class), so it is partially aggregated
    like the other statistics: one shuffle in total.
    """
    return (readings.filter(f"{_HAS_LOCATION} AND {NOISE} IS NOT NULL")
            .groupBy("location_type")
            .agg(*_aggs(*_stats5(), "mode(noise_category, true) AS most_common_category"))
            .orderBy(F.desc("avg_noise_db"), "location_type"))


def peak_hours_by_location(readings: DataFrame) -> DataFrame:
    """Query 7: (location, hour) averages, loudest hour first per location (A10)."""
    return (readings.filter(f"{_HAS_LOCATION} AND {NOISE} IS NOT NULL")
            .groupBy("location_type", "hour")
            .agg(*_aggs(f"{R(f'avg({NOISE})')} AS avg_noise_db", "count(1) AS measurement_count"))
            .orderBy("location_type", F.desc("avg_noise_db"), "hour"))


def monthly_trends(series: DataFrame, time_col: str = "timestamp", value_col: str = NOISE,
                   high_threshold: float = 70.0) -> DataFrame:
    """Query 8: per calendar month (``yyyy-MM`` of the parsed time) count, avg,
    population std and the count above ``high_threshold`` (A11)."""
    x = q(value_col)
    return (series.filter(f"{x} IS NOT NULL")
            .groupBy(E(f"date_format({q(time_col)}, 'yyyy-MM') AS month"))
            .agg(*_aggs("count(1) AS measurement_count",
                        f"{R(f'avg({x})')} AS avg_noise_db",
                        f"{R(f'stddev_pop({x})')} AS std_dev_db",
                        f"count_if({x} > {X.dbl(high_threshold)}) AS high_noise_count"))
            .orderBy("month"))


def with_share_of_total(grouped: DataFrame, count_col: str, out: str = "percentage",
                        closed: bool = False) -> DataFrame:
    """``100 * n / sum(n)`` over all groups (W1, ``SUM(COUNT(*)) OVER ()``).

    For a closed set of values (``closed``: classes, statuses) the total is a
    window over the few grouped rows: one scan. Otherwise it is a scalar
    subquery over the grouped rows, so a column with millions of distinct
    values never lands in one task."""
    if closed:
        total = F.sum(count_col).over(Window.partitionBy())
    else:
        total = grouped.agg(F.sum(count_col).alias("_t")).scalar()
    return grouped.withColumn(out, X.round_half_up(F.lit(100.0) * F.col(count_col) / total))


def category_distribution(readings: DataFrame) -> DataFrame:
    """Query 9: rows per noise class with share of total."""
    grouped = (readings.filter("noise_category IS NOT NULL")
               .groupBy("noise_category")
               .agg(*_aggs("count(1) AS count",
                           f"{R(f'avg({NOISE})')} AS avg_noise_db",
                           f"{R(f'min({NOISE})')} AS min_noise_db",
                           f"{R(f'max({NOISE})')} AS max_noise_db")))
    return (with_share_of_total(grouped, "count", closed=True)
            .select("noise_category", "count", "percentage", "avg_noise_db",
                    "min_noise_db", "max_noise_db")
            .orderBy(F.desc("count"), "noise_category"))


def zone_hour_day(readings: DataFrame, min_count: int = 5, top: int = 100) -> DataFrame:
    """Query 10: (zone, hour, day) with at least ``min_count`` rows, top ``top``
    by average (A13)."""
    return (readings.filter(f"geo_zone IS NOT NULL AND {NOISE} IS NOT NULL")
            .groupBy("geo_zone", "hour", "day_of_week")
            .agg(*_aggs("count(1) AS sample_size",
                        f"{R(f'avg({NOISE})')} AS avg_noise_db",
                        f"{R(f'stddev_pop({NOISE})')} AS std_dev_db"))
            .filter(f"sample_size >= {min_count}")
            .orderBy(F.desc("avg_noise_db"), "geo_zone", "hour", "day_of_week")
            .limit(top))


SUMMARY_KEYS = ["geo_zone", "location_type", "hour", "day_of_week"]


def summary_view(readings: DataFrame, exact: bool = True) -> DataFrame:
    """Query 11: dashboard summary by (zone, location, hour, day)."""
    aggs = ["count(1) AS total_measurements",
            f"{R(f'avg({NOISE})')} AS avg_noise_db",
            f"{R(f'stddev_pop({NOISE})')} AS std_dev_db",
            f"{R(f'min({NOISE})')} AS min_noise_db",
            f"{R(f'max({NOISE})')} AS max_noise_db",
            f"count_if({NOISE} > 80.0D) AS extreme_noise_events",
            f"count_if({NOISE} < 50.0D) AS quiet_events"]
    return (_with_percentiles(readings.filter(f"{NOISE} IS NOT NULL"), SUMMARY_KEYS, aggs, {"median_noise_db": 0.5}, exact)
            .selectExpr(*SUMMARY_KEYS, f"{X.day_type_sql('day_of_week')} AS day_type",
                        "total_measurements", "avg_noise_db", "std_dev_db", "min_noise_db",
                        "max_noise_db", "median_noise_db", "extreme_noise_events", "quiet_events"))


def export_aggregates(readings: DataFrame) -> DataFrame:
    """Query 12: the summary grain for export (A15). Mean and deviation come from
    exact sums, to six decimals, so they depend on no order of rows."""
    sums = (readings.filter(f"{NOISE} IS NOT NULL").groupBy(*SUMMARY_KEYS)
            .agg(*_aggs(*fixed.sums_sql(NOISE), f"max({NOISE}) AS max_noise_db", f"min({NOISE}) AS min_noise_db")))
    return sums.selectExpr(*SUMMARY_KEYS, f"{export_figure_sql(fixed.mean_sql())} AS avg_noise_db",
                           f"{export_figure_sql(fixed.std_sql())} AS std_dev_db", "n AS sample_count",
                           "max_noise_db", "min_noise_db")


def export_figure_sql(x: str) -> str:
    """An exported mean or deviation: whole units, half up."""
    unit = f"{10 ** fixed.DIGITS}D"
    return f"floor({x} * {unit} + 0.5D) / {unit}"


def zone_hourly_stats(readings: DataFrame) -> DataFrame:
    """Hourly zone statistics per day with a class -> count MAP (A17, K6 input).

    The class is a closed set of six labels, so the map is six conditional
    counts in the same single aggregate (no second shuffle, no join), with
    absent classes filtered out of the map.
    """
    labels = X.ALL_NOISE_CLASSES
    counts = [f"count_if(noise_category = {X.s(l)}) AS _n{i}" for i, l in enumerate(labels)]
    agg = (readings.filter(f"{NOISE} IS NOT NULL")
           .groupBy("geo_zone", "hour", E("date_format(`timestamp`, 'yyyy-MM-dd') AS date_partition"))
           .agg(*_aggs(f"{R(f'avg({NOISE})')} AS avg_noise_db",
                       f"{R(f'max({NOISE})')} AS max_noise_db",
                       f"{R(f'min({NOISE})')} AS min_noise_db",
                       f"{R(f'stddev_pop({NOISE})')} AS std_dev_db",
                       "count(1) AS sample_count", *counts)))
    keys = ", ".join(X.s(l) for l in labels)
    vals = ", ".join(f"_n{i}" for i in range(len(labels)))
    cmap = f"map_filter(map_from_arrays(array({keys}), array({vals})), (k, v) -> v > 0)"
    return agg.selectExpr("geo_zone", "hour", "avg_noise_db", "max_noise_db", "min_noise_db",
                          "std_dev_db", "sample_count", f"{cmap} AS noise_category_distribution",
                          "date_partition")


def explode_category_map(stats: DataFrame) -> DataFrame:
    """Hourly zone statistics with the class map as rows (for comparison)."""
    return stats.selectExpr("geo_zone", "hour", "date_partition", "avg_noise_db", "max_noise_db",
                            "min_noise_db", "std_dev_db", "sample_count",
                            "explode(noise_category_distribution) AS (noise_category, category_count)")
