"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver tables (or what Spark derives from them) in
full. Limits appear only where the top-k or the sample is the feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quietude.functions.expr import round_half_up_sql
from quietude.operators import complaints as C
from quietude.operators import dashboard, distinct, features, report, stats, text, trends
from quietude.session import ensure_checkpoint_dir
from quietude.sinks.keyed import KeyedTable
from quietude.sinks.writers import HOURLY_STATS_DDL, upsert
from quietude.sources import adapter, raw
from quietude.sources.tables import document_lines, table

# Fixed job parameters of the registered queries.
SEARCH_KEYWORD = "data"
UPSERT_CUTOFF = "2024-01-16 00:00:00"
UPSERT_SOUTH = 1.31  # readings south of it all come with the first batch, so their zones stay
COMPLAINT_COUNT = 500  # of the sample itself; the analytics take every complaint
HOTSPOT_DB = 65.0
SAMPLE_SEED = 7

Query = Callable[[SparkSession, str], DataFrame]


def _readings(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.readings(table(spark, sf, "events"))


def _unzoned(spark: SparkSession, sf: str) -> DataFrame:
    """Readings for the queries without zones: no pass for the zone bounds."""
    return adapter.readings(table(spark, sf, "events"), with_zone=False)


def _store(spark: SparkSession, sf: str) -> DataFrame:
    return features.readings_complete(_readings(spark, sf))


def _complaints(spark: SparkSession, sf: str, zones: bool = False) -> DataFrame:
    return C.all_complaints(_readings(spark, sf) if zones else _unzoned(spark, sf))


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("text")


# --- features -------------------------------------------------------------

def q_readings_clean(spark, sf):
    lines = features.readings_as_tsv_lines(adapter.readings(table(spark, sf, "events"), keep_id=False))
    return features.parse_readings_lines(lines)


def q_noise_category(spark, sf):
    r = _unzoned(spark, sf)
    return r.select("reading_id", "noise_level_db", "noise_category")


def q_noise_adjusted(spark, sf):
    inp = adapter.offset_inputs(table(spark, sf, "events"))
    out = features.with_noise_adjusted(inp, "base_noise_db", "location_type", "measured_db")
    return out.select("reading_id", "location_type", "noise_level_db")


def q_geo_zone(spark, sf):
    return _readings(spark, sf).select("reading_id", "latitude", "longitude", "geo_zone")


def q_readings_complete(spark, sf):
    return _store(spark, sf).select("reading_id", "participant_id", "noise_level_db", "geo_zone")


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    lines = adapter.raw_csv_lines(table(spark, sf, "events"))
    return raw.with_faults(raw.parse_lines(lines, adapter.RAW_COLUMNS), ("base_db",))


def q_raw_readings(spark, sf):
    good = raw.accepted(_raw(spark, sf), ("base_db",))
    return features.export_columns(features.rename_to_table(features.preprocess_raw(good, "base_db")))


def q_raw_faults(spark, sf):
    return raw.fault_counts(raw.faults(_raw(spark, sf)))


def q_store_rows(spark, sf):
    return features.store_coerce(_store(spark, sf))


# --- trends ---------------------------------------------------------------

def q_hourly_trends(spark, sf):
    return trends.hourly_trends(_unzoned(spark, sf))


def q_zone_hotspots(spark, sf):
    return trends.zone_hotspots(_readings(spark, sf))


def q_weekday_weekend(spark, sf):
    return trends.weekday_weekend(_unzoned(spark, sf))


def q_location_analysis(spark, sf):
    return trends.location_analysis(_unzoned(spark, sf))


def q_peak_hours_by_location(spark, sf):
    return trends.peak_hours_by_location(_unzoned(spark, sf))


def q_monthly_trends(spark, sf):
    return trends.monthly_trends(adapter.order_series(table(spark, sf, "orders")),
                                 value_col="value", high_threshold=250000.0)


def q_category_distribution(spark, sf):
    return trends.category_distribution(_unzoned(spark, sf))


def q_zone_hour_day(spark, sf):
    return trends.zone_hour_day(_readings(spark, sf))


def q_summary_view(spark, sf):
    return trends.summary_view(_readings(spark, sf))


def q_export_aggregates(spark, sf):
    return trends.export_aggregates(_readings(spark, sf))


def q_zone_hourly_stats(spark, sf):
    return trends.explode_category_map(trends.zone_hourly_stats(_readings(spark, sf)))


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the session's shared checkpoint folder, gone with the driver."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quietude-{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def _loads(readings: DataFrame) -> dict[str, DataFrame]:
    """All readings in three loads; the first two share their days."""
    early = f"`timestamp` < TIMESTAMP_NTZ '{UPSERT_CUTOFF}'"
    return {"a": readings.filter(f"{early} AND reading_id % 2 = 0"), "b": readings.filter(f"{early} AND reading_id % 2 != 0"),
            "c": readings.filter(f"NOT coalesce({early}, false)")}


def q_summary_kept(spark, sf):
    """The dashboard over stored histograms: three loads, one of them run twice."""
    path, readings = _scratch(spark, "histograms"), _readings(spark, sf)
    loads = _loads(readings)
    for load_id, rows in (*loads.items(), ("b", loads["b"])):
        dashboard.load_histograms(rows, path, load_id)
    return dashboard.kept_summary(dashboard.histograms(spark, path))


def q_zone_hourly_loads(spark, sf):
    """The hourly table kept by three loads, its class map as rows."""
    path, readings = _scratch(spark, "hourly"), _readings(spark, sf)
    for load_id, rows in _loads(readings).items():
        dashboard.load_hourly(rows, f"{path}/partials", f"{path}/table", load_id)
    kept = spark.read.schema(HOURLY_STATS_DDL).parquet(f"{path}/table")
    return trends.explode_category_map(kept)


# --- statistics -----------------------------------------------------------

def q_noise_grouping_sets(spark, sf):
    return stats.noise_grouping_sets(_readings(spark, sf))


def q_moments_partial(spark, sf):
    p = stats.moments_partial(_readings(spark, sf))
    return p.selectExpr("key", "date", "n", "min_x", "max_x",
                        f"{round_half_up_sql('CAST(s AS DOUBLE) / 1e6D', 6)} AS sum_x",
                        f"{round_half_up_sql('(CAST(q_hi AS DOUBLE) * 1e19D + CAST(q_lo AS DOUBLE)) / 1e12D', 6)} AS sum_x2")


def q_moments_merge(spark, sf):
    return stats.moments_merge(stats.moments_partial(_readings(spark, sf)))


def q_zone_statistics(spark, sf):
    return stats.zone_statistics(_store(spark, sf))


def q_hotspots_threshold(spark, sf):
    return stats.hotspots_threshold(stats.zone_statistics(_store(spark, sf)), threshold=HOTSPOT_DB)


def q_hourly_patterns(spark, sf):
    return stats.hourly_patterns(features.readings_complete(_unzoned(spark, sf)))


def q_dataset_stats(spark, sf):
    return stats.dataset_stats(_store(spark, sf))


def q_readings_overview(spark, sf):
    return stats.readings_overview(_unzoned(spark, sf))


def q_noise_describe(spark, sf):
    return stats.noise_describe(_unzoned(spark, sf))


def q_noise_summary(spark, sf):
    return stats.noise_summary(_unzoned(spark, sf))


def q_value_counts(spark, sf):
    return stats.value_counts(_unzoned(spark, sf), "location_type")


def q_group_mode(spark, sf):
    return stats.group_mode(_unzoned(spark, sf), ["location_type"], "noise_kind")


def q_top_zones(spark, sf):
    return stats.top_zones(_readings(spark, sf))


def q_distinct_zones(spark, sf):
    return stats.distinct_zones(_store(spark, sf))


def q_zone_stats_upsert(spark, sf):
    store = _store(spark, sf)
    cut = f"TIMESTAMP_NTZ '{UPSERT_CUTOFF}'"
    second = f"`timestamp` >= {cut} AND latitude >= {UPSERT_SOUTH}D"
    old = stats.zone_statistics(store.filter(f"NOT ({second})"))
    new = stats.zone_statistics(store.filter(second))
    return upsert(old, new, "geo_zone")


def q_zone_stats_keyed(spark, sf):
    """The same upsert on a keyed table: only the buckets of the second batch are rewritten."""
    store = _store(spark, sf)
    second = f"`timestamp` >= TIMESTAMP_NTZ '{UPSERT_CUTOFF}' AND latitude >= {UPSERT_SOUTH}D"
    kept = KeyedTable(spark, _scratch(spark, "zones"), "geo_zone", buckets=16)
    for batch in (store.filter(f"NOT ({second})"), store.filter(second)):
        kept.upsert(stats.zone_statistics(batch))
    return kept.read()


def q_participants_trailing(spark, sf):
    """Distinct participants of the seven days up to each day, from daily bitmaps."""
    readings, path = _unzoned(spark, sf), _scratch(spark, "participants")
    distinct.numbered(readings, "participant_id").write.parquet(f"{path}/ids")
    distinct.day_bitmaps(readings, "participant_id", spark.read.parquet(f"{path}/ids")).write.parquet(f"{path}/days")
    return distinct.trailing(spark.read.parquet(f"{path}/days"), days=7)


# --- text -----------------------------------------------------------------

def q_word_count(spark, sf):
    return text.word_count(_docs(spark, sf).withColumnRenamed("text", "value"))


def q_keyword_search(spark, sf):
    return text.keyword_search(document_lines(_docs(spark, sf)), SEARCH_KEYWORD)


def q_keyword_count(spark, sf):
    return text.keyword_count(document_lines(_docs(spark, sf)), SEARCH_KEYWORD)


def q_sort_by_name(spark, sf):
    return text.sort_by_name(adapter.customer_records(table(spark, sf, "customer")))


def q_word_frequency(spark, sf):
    return text.word_frequency(_docs(spark, sf))


def q_word_frequency_bounded(spark, sf):
    return text.word_frequency_bounded(_docs(spark, sf))


def q_keyword_categories(spark, sf):
    return text.keyword_categories(_docs(spark, sf))


# --- complaints -----------------------------------------------------------

def q_complaint_route(spark, sf):
    return C.complaint_route(_unzoned(spark, sf))


def q_weighted_assign(spark, sf):
    return C.weighted_assign(_unzoned(spark, sf))


def q_sample_high_noise(spark, sf):
    return C.sample_high_noise(_readings(spark, sf), COMPLAINT_COUNT).select(
        "reading_id", "timestamp", "noise_level_db", "location_type", "geo_zone")


def q_sample_uniform(spark, sf):
    high = _unzoned(spark, sf).filter(f"noise_level_db > {C.HIGH_NOISE_DB}D")
    return C.sample_uniform(high, COMPLAINT_COUNT, SAMPLE_SEED).select("reading_id", "timestamp", "noise_level_db", "location_type")


def q_complaints(spark, sf):
    return C.complaints(_readings(spark, sf), COMPLAINT_COUNT)


def q_complaints_by_hour(spark, sf):
    return C.complaints_by_hour(_complaints(spark, sf))


def q_complaint_zones(spark, sf):
    return C.complaint_zones(_complaints(spark, sf, zones=True))


def q_complaints_by_weekday(spark, sf):
    return C.complaints_by_weekday(_complaints(spark, sf))


def q_complaint_status(spark, sf):
    return C.complaint_status(_complaints(spark, sf))


def q_top_zone_share(spark, sf):
    return C.top_zone_share(_complaints(spark, sf, zones=True))


def q_peak_hour(spark, sf):
    return C.peak_hour(_complaints(spark, sf))


def q_top_category(spark, sf):
    return C.top_category(_complaints(spark, sf))


def q_unresolved_share(spark, sf):
    return C.unresolved_share(_complaints(spark, sf))


def q_complaint_report(spark, sf):
    r = _readings(spark, sf)
    return report.report_flat(C.all_complaints(r), r)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
