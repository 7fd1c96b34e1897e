"""Keyed statistics: five-way grouping sets, mergeable partial moments, zone
and hourly roll-ups, store-level statistics, describe/summary, value counts,
group mode, top zones, distinct zones, hotspot thresholds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.functions import exact as fixed
from quietude.functions import expr as X
from quietude.functions.expr import E, q
from quietude.functions.expr import round_half_up_sql as R
from quietude.operators import ranks

NOISE = "noise_level_db"

# grouping_id() bits for columns (geo_zone, location_type, hour, day_of_week);
# a set bit means the column is not in the grouping set.
GROUPING_SET_KEYS = {
    5: ("zone_hour", ["geo_zone", "hour"]),
    9: ("location_hour", ["location_type", "hour"]),
    14: ("day", ["day_of_week"]),
    13: ("hour", ["hour"]),
    7: ("zone", ["geo_zone"]),
}
_KEY_COLS = ["geo_zone", "location_type", "hour", "day_of_week"]


def _composite_key_sql() -> str:
    """``kind:part:part`` key built from the grouping id (on final rows only)."""
    whens = []
    for g, (kind, cols) in GROUPING_SET_KEYS.items():
        parts = ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in cols)
        whens.append(f"WHEN _gid = {g} THEN concat_ws(':', '{kind}', {parts})")
    return f"CASE {' '.join(whens)} END"


def _keyed_rows(readings: DataFrame) -> DataFrame:
    """Rows the five-way key stream accepts: noise, time and hour present."""
    return readings.filter(f"{NOISE} IS NOT NULL AND `timestamp` IS NOT NULL AND hour IS NOT NULL")


def _grouping_sets(df: DataFrame, aggs: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """One scan, five groupings (Expand + partial aggregate). ``extra`` columns
    join every set. The location set drops rows with a NULL or blank
    location."""
    sets = [[*cols, *extra] for _, (_, cols) in sorted(GROUPING_SET_KEYS.items())]
    out = (df.groupingSets([[F.col(c) for c in s] for s in sets], *_KEY_COLS, *extra)
           .agg(*[E(a) for a in aggs], E(f"shiftright(grouping_id(), {len(extra)}) AS _gid")))
    return out.filter("_gid != 9 OR (location_type IS NOT NULL AND location_type != '')")


def noise_grouping_sets(readings: DataFrame) -> DataFrame:
    """Per composite key count, mean, population std, min, max (A3, P15, P16,
    O2), sorted by the key as text."""
    out = _grouping_sets(_keyed_rows(readings), [
        "count(1) AS count",
        f"{R(f'avg({NOISE})')} AS mean_db",
        f"{R(f'stddev_pop({NOISE})')} AS std_dev",
        f"{R(f'min({NOISE})')} AS min_db",
        f"{R(f'max({NOISE})')} AS max_db"])
    return (out.selectExpr(f"{_composite_key_sql()} AS key", "count", "mean_db", "std_dev",
                           "min_db", "max_db")
            .orderBy("key"))


def moments_partial(readings: DataFrame, split_cols: tuple[str, ...] = ("date",)) -> DataFrame:
    """Partial moments per composite key and split: count, min, max, and the
    exact sums of ``functions.exact`` (A4). Splits (default: the reading date)
    are the units an incremental load stores and later merges. One scan: the
    five key sets are grouping sets, each extended by the split columns."""
    df = _keyed_rows(readings)
    if "date" in split_cols and "date" not in df.columns:
        df = df.withColumn("date", E("to_date(`timestamp`)"))
    out = _grouping_sets(df, [*fixed.sums_sql(NOISE), f"min({NOISE}) AS min_x", f"max({NOISE}) AS max_x"],
                         extra=tuple(split_cols))
    return out.selectExpr(f"{_composite_key_sql()} AS key", *[q(c) for c in split_cols], *fixed.SUMS, "min_x", "max_x")


def moments_merge(partials: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """Merge stored partials to count, mean, population std, min and max (A5).
    Sums are exact, so any split of the partials, merged in any order, gives
    the same result and roll-ups can be incremental."""
    key_cols = key_cols or ["key"]
    merged = (partials.groupBy(*key_cols)
              .agg(*[E(a) for a in (*fixed.merge_sql(), "min(min_x) AS min_x", "max(max_x) AS max_x")]))
    return (merged.selectExpr(*[q(k) for k in key_cols],
                              "n AS count",
                              f"{R(fixed.mean_sql())} AS mean_db",
                              f"{R(fixed.std_sql())} AS std_dev",
                              f"{R('min_x')} AS min_db",
                              f"{R('max_x')} AS max_db")
            .orderBy(*key_cols))


def zone_statistics(store: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Per-zone avg/max/min, sample std (0 when n <= 1), count, rounded to 2
    places; a zero value is stored as NULL (A16). ``last_updated`` is the
    ``run_ts`` parameter, not the wall clock, so reruns are reproducible."""

    def nz(v: str) -> str:
        return f"CASE WHEN {v} IS NOT NULL AND {v} != 0 THEN {R(v)} END"

    out = (store.filter("geo_zone IS NOT NULL")
           .groupBy("geo_zone")
           .agg(*[E(a) for a in (f"avg({NOISE}) AS a", f"max({NOISE}) AS mx", f"min({NOISE}) AS mn",
                                 f"stddev_samp({NOISE}) AS s", "count(1) AS sample_count")]))
    cols = ["geo_zone", f"{nz('a')} AS avg_noise_db", f"{nz('mx')} AS max_noise_db",
            f"{nz('mn')} AS min_noise_db",
            f"{nz('(CASE WHEN sample_count > 1 THEN s ELSE 0.0D END)')} AS std_dev_db", "sample_count"]
    if run_ts is not None:
        cols.append(f"{X.s(run_ts)} AS last_updated")
    return out.selectExpr(*cols)


def hotspots_threshold(zone_stats: DataFrame, threshold: float = 75.0,
                       min_count: int = 10) -> DataFrame:
    """Zones with average >= ``threshold`` and at least ``min_count`` rows (P5)."""
    return (zone_stats.filter(f"avg_noise_db >= {X.dbl(threshold)} AND sample_count >= {min_count}")
            .select("geo_zone", "avg_noise_db", "sample_count")
            .orderBy(F.desc("avg_noise_db"), "geo_zone"))


def hourly_patterns(store: DataFrame) -> DataFrame:
    """Per hour avg (rounded), max (raw), count."""
    return (store.filter("hour IS NOT NULL")
            .groupBy("hour")
            .agg(*[E(a) for a in (f"{R(f'avg({NOISE})')} AS avg_noise_db", f"max({NOISE}) AS max_noise_db",
                                  "count(1) AS sample_count")])
            .orderBy("hour"))


def dataset_stats(store: DataFrame) -> DataFrame:
    """Store-level count, avg, min, max, distinct participants and zones.
    The distinct counts deduplicate on (value) across tasks; only the final
    counts meet in one task."""
    return store.agg(*[E(a) for a in (
        "count(1) AS total_records", f"{R(f'avg({NOISE})')} AS avg_noise_db",
        f"min({NOISE}) AS min_noise_db", f"max({NOISE}) AS max_noise_db",
        "count(DISTINCT participant_id) AS participants", "count(DISTINCT geo_zone) AS zones")])


def readings_overview(readings: DataFrame) -> DataFrame:
    """Measurements, first and last time, distinct participants (A19, the
    preprocessing summary)."""
    return readings.agg(*[E(a) for a in (
        "count(1) AS total_measurements", "min(`timestamp`) AS first_time",
        "max(`timestamp`) AS last_time", "count(DISTINCT participant_id) AS participants")])


def noise_describe(readings: DataFrame, col: str = NOISE, digits: int = 5,
                   exact: bool = True) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 %, max (A20). Quartiles are exact
    and interpolated, by rank selection in bounded state; ``exact=False`` uses
    ``percentile_approx``."""
    x, probs = q(col), {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    aggs = [f"count({x}) AS count", f"{R(f'avg({x})', digits)} AS mean",
            f"{R(f'stddev_samp({x})', digits)} AS std", f"min({x}) AS min", f"max({x}) AS max"]
    out = _overall(readings, x, aggs, probs, exact)
    return out.selectExpr("count", "mean", "std", "min", *[f"{R(p, digits)} AS {p}" for p in probs], "max")


def noise_summary(readings: DataFrame, col: str = NOISE, exact: bool = True) -> DataFrame:
    """Whole-table count, mean, sample std, min, max, median, 2 places."""
    x = q(col)
    aggs = ["count(1) AS total_records", f"{R(f'avg({x})')} AS mean_db", f"{R(f'stddev_samp({x})')} AS std_dev_db",
            f"{R(f'min({x})')} AS min_db", f"{R(f'max({x})')} AS max_db"]
    return _overall(readings, x, aggs, {"median_db": 0.5}, exact).withColumn("median_db", E(R("median_db")))


def _overall(rows: DataFrame, x: str, aggs: list[str], probs: dict[str, float], exact: bool) -> DataFrame:
    if exact:
        return ranks.with_percentiles(rows, [], x, aggs, probs)
    approx = [f"percentile_approx({x}, {X.dbl(p)}, 10000) AS {name}" for name, p in probs.items()]
    return rows.agg(*[E(a) for a in (*aggs, *approx)])


def value_counts(df: DataFrame, col: str, with_pct: bool = True, closed: bool = False) -> DataFrame:
    """Count per value, most frequent first, ties by value; optional share of
    non-null rows in percent (A22). ``closed``: the column has a small fixed
    set of values."""
    out = df.filter(f"{q(col)} IS NOT NULL").groupBy(col).agg(E("count(1) AS count"))
    if with_pct:
        from quietude.operators.trends import with_share_of_total
        out = with_share_of_total(out, "count", "percentage", closed)
    return out.orderBy(F.desc("count"), col)


def group_mode(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """Most frequent non-null value per group, ties to the lowest value, with its
    count (A23). Two partial aggregates: (group, value) counts, then an
    arg-max per group; no window sort and no group gathered in one task."""
    v = q(value_col)
    counts = df.filter(f"{v} IS NOT NULL").groupBy(*group_cols, value_col).agg(E("count(1) AS _n"))
    best = f"min_by(named_struct('v', {v}, 'n', _n), named_struct('neg_n', -_n, 'v', {v})) AS _b"
    return (counts.groupBy(*group_cols).agg(E(best))
            .selectExpr(*[q(g) for g in group_cols], "_b.v AS mode_value", "_b.n AS mode_count"))


def top_zones(readings: DataFrame, min_count: int = 10, top: int = 10) -> DataFrame:
    """Top ``top`` zones by mean noise with at least ``min_count`` rows."""
    return (readings.groupBy("geo_zone")
            .agg(E(f"{R(f'avg({NOISE})')} AS mean_db"), E(f"count({NOISE}) AS count"))
            .filter(f"count >= {min_count}")
            .orderBy(F.desc("mean_db"), "geo_zone")
            .limit(top))


def distinct_zones(store: DataFrame) -> DataFrame:
    """Distinct non-null zones."""
    return store.select("geo_zone").filter("geo_zone IS NOT NULL").distinct()
