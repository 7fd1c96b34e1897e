"""Complaint analytics report (A32, I1-I4 as one document, K10 input).

Built from two aggregates and no join: one grouping-sets pass over the
complaints (per category, hour, status, zone and overall), then one global
aggregate over those few grouped rows (at most categories + 24 hours +
statuses + zones + 1) that assembles the maps and the insights. The reading
total is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quietude.functions import expr as X
from quietude.functions.expr import E
from quietude.functions.expr import round_half_up_sql as R
from quietude.operators.complaints import CATEGORY_HIGH_PCT, UNRESOLVED, UNRESOLVED_HIGH_PCT, priority_sql

# grouping_id() over (category, hour, status, geo_zone) for each section
_GID = {"category": 7, "hour": 11, "status": 13, "zone": 14, "all": 15}
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _grouped(c: DataFrame) -> DataFrame:
    keys = ["category", "hour", "status", "geo_zone"]
    return (c.groupingSets([["category"], ["hour"], ["status"], ["geo_zone"], []], *keys)
            .agg(*[E(a) for a in ("count(1) AS n", "sum(estimated_noise_db) AS s",
                                  "max(estimated_noise_db) AS mx", "min(`timestamp`) AS t0",
                                  "max(`timestamp`) AS t1", "grouping_id() AS gid")]))


def _entries_sql(gid: int, key: str, by_key: bool = False) -> str:
    """Sorted (count desc, key) or (key) array of one section's entries; NULL
    keys are not counted."""
    if by_key:
        e = f"named_struct('k', {key}, 'n', n, 's', s)"
    else:
        e = f"named_struct('neg_n', -n, 'k', {key}, 'n', n, 's', s)"
    return f"array_sort(collect_list(CASE WHEN gid = {gid} AND {key} IS NOT NULL THEN {e} END))"


def report_parts(c: DataFrame, readings: DataFrame) -> DataFrame:
    """One row with every report figure as plain columns and sorted entry arrays."""
    total_readings = readings.agg(E("count(1)")).scalar()
    states = ", ".join(X.s(u) for u in UNRESOLVED)
    a = _GID["all"]
    return _grouped(c).agg(*[E(x) for x in (
        f"max(CASE WHEN gid = {a} THEN n END) AS total_complaints",
        f"max(CASE WHEN gid = {a} THEN t0 END) AS date_start",
        f"max(CASE WHEN gid = {a} THEN t1 END) AS date_end",
        f"max(CASE WHEN gid = {a} THEN s / n END) AS avg_noise_level_db",
        f"max(CASE WHEN gid = {a} THEN mx END) AS max_noise_level_db",
        f"{_entries_sql(_GID['category'], 'category')} AS categories",
        f"{_entries_sql(_GID['hour'], 'hour', by_key=True)} AS hours",
        f"{_entries_sql(_GID['status'], 'status')} AS statuses",
        f"{_entries_sql(_GID['zone'], 'geo_zone')} AS zones",
        f"sum(CASE WHEN gid = {_GID['status']} AND status IN ({states}) THEN n END) AS unresolved_count",
    )]).withColumn("total_readings", total_readings)


def _insights_sql() -> str:
    top5 = "slice(zones, 1, 5)"
    top5_n = f"aggregate({top5}, 0L, (a, e) -> a + e.n)"
    top5_s = f"aggregate({top5}, 0.0D, (a, e) -> a + e.s)"
    peak = ("try_element_at(array_sort(transform(hours, e -> named_struct('neg_n', -e.n, 'k', e.k, 'n', e.n))), 1)")
    cat = "try_element_at(categories, 1)"
    cat_pct = f"(100.0D * {cat}.n / total_complaints)"
    unres = "coalesce(unresolved_count, 0L)"
    unres_pct = f"(100.0D * {unres} / total_complaints)"

    def item(kind: str, prio: str, **m: str) -> str:
        fields = {"avg_noise_db": "CAST(NULL AS DOUBLE)", "peak_hour": "CAST(NULL AS BIGINT)",
                  "peak_count": "CAST(NULL AS BIGINT)",
                  "category": "CAST(NULL AS STRING)", "unresolved_count": "CAST(NULL AS BIGINT)",
                  "share_pct": "CAST(NULL AS DOUBLE)"}
        fields.update(m)
        body = ", ".join(f"'{k}', {v}" for k, v in fields.items())
        return f"named_struct('type', {X.s(kind)}, 'priority', {prio}, {body})"

    return "array(" + ", ".join([
        item("Geographic Hotspot", "'High'", avg_noise_db=R(f"{top5_s} / nullif({top5_n}, 0L)"),
             share_pct=R(f"100.0D * {top5_n} / total_complaints")),
        item("Temporal Pattern", "'Medium'", peak_hour=f"CAST({peak}.k AS BIGINT)", peak_count=f"{peak}.n"),
        item("Complaint Category", priority_sql(cat_pct, CATEGORY_HIGH_PCT), category=f"{cat}.k",
             share_pct=R(cat_pct)),
        item("Response Efficiency", priority_sql(unres_pct, UNRESOLVED_HIGH_PCT),
             unresolved_count=unres, share_pct=R(unres_pct)),
    ]) + ")"


def _as_map_sql(entries: str, limit: int | None = None) -> str:
    arr = f"slice({entries}, 1, {limit})" if limit else entries
    return f"map_from_entries(transform({arr}, e -> named_struct('k', e.k, 'n', e.n)))"


def report_document(c: DataFrame, readings: DataFrame, run_ts: str | None = None) -> DataFrame:
    """The nested report: summary struct, four count maps, insights array."""
    gen = X.s(run_ts) if run_ts is not None else "CAST(NULL AS STRING)"
    return report_parts(c, readings).selectExpr(
        f"{gen} AS generated_at",
        "named_struct('total_complaints', total_complaints, 'total_sensors', total_readings, "
        f"'date_range', named_struct('start', date_format(date_start, '{TS_FORMAT}'), "
        f"'end', date_format(date_end, '{TS_FORMAT}')), "
        "'avg_noise_level_db', avg_noise_level_db, 'max_noise_level_db', max_noise_level_db) AS summary",
        f"{_as_map_sql('categories')} AS category_distribution",
        f"{_as_map_sql('hours')} AS hourly_distribution",
        f"{_as_map_sql('statuses')} AS status_distribution",
        f"{_as_map_sql('zones', 10)} AS top_complaint_zones",
        f"{_insights_sql()} AS insights",
    )


def _json_pairs_sql(entries: str, limit: int | None = None) -> str:
    """Entries as ``{"key":n,...}`` text in entry order."""
    arr = f"slice({entries}, 1, {limit})" if limit else entries
    body = f"array_join(transform({arr}, e -> concat('\"', CAST(e.k AS STRING), '\":', CAST(e.n AS STRING))), ',')"
    return f"concat('{{', {body}, '}}')"


def report_flat(c: DataFrame, readings: DataFrame) -> DataFrame:
    """The report as one flat row (summary scalars, maps as ordered JSON text,
    insight figures) for comparison and CSV export. The insights array is
    built once into a column and read field by field."""
    p = report_parts(c, readings).selectExpr("*", f"{_insights_sql()} AS _ins")
    return p.selectExpr(
        "total_complaints", "total_readings",
        f"date_format(date_start, '{TS_FORMAT}') AS date_start",
        f"date_format(date_end, '{TS_FORMAT}') AS date_end",
        f"{R('avg_noise_level_db', 6)} AS avg_noise_level_db",
        "max_noise_level_db",
        f"{_json_pairs_sql('categories')} AS category_distribution",
        f"{_json_pairs_sql('hours')} AS hourly_distribution",
        f"{_json_pairs_sql('statuses')} AS status_distribution",
        f"{_json_pairs_sql('zones', 10)} AS top_complaint_zones",
        "_ins[0].share_pct AS top5_zone_share_pct",
        "_ins[0].avg_noise_db AS top5_avg_noise_db",
        "_ins[1].peak_hour AS peak_hour",
        "_ins[1].peak_count AS peak_count",
        "_ins[2].category AS top_category",
        "_ins[2].priority AS category_priority",
        "_ins[3].unresolved_count AS unresolved_count",
        "_ins[3].priority AS unresolved_priority",
    )

