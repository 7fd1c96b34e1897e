"""Upsert, share of total, exact export, report, raw times and compaction."""

import datetime as dt
import uuid

import pytest
from pyspark.errors import AnalysisException, PySparkException

from quietude.operators import complaints as C
from quietude.operators import features, report, trends
from quietude.plans import catalog
from quietude.sinks import writers as W
from quietude.sources.schemas import RAW_SENSOR_SCHEMA
from quietude.streaming import incremental as S

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_one_row_per_key(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], "k string, v int, at int")
    new = spark.createDataFrame([("b", 5, 1), ("b", 3, 2), ("c", 7, 1), ("c", 7, 1)], "k string, v int, at int")
    assert _rows(W.upsert(old, new, "k", "at")) == [("a", 1, 0), ("b", 3, 2), ("c", 7, 1)]
    assert _rows(W.upsert(None, new, "k", "at")) == [("b", 3, 2), ("c", 7, 1)]
    assert _rows(W.upsert(W.upsert(old, new, "k", "at"), new, "k", "at")) == [("a", 1, 0), ("b", 3, 2), ("c", 7, 1)]


def test_upsert_null_key_map_and_key_only(spark):
    old = spark.sql("SELECT CAST(NULL AS STRING) AS k, map('x', 1) AS m")
    new = spark.sql("SELECT CAST(NULL AS STRING) AS k, map('x', 2) AS m")
    assert [r["m"] for r in W.upsert(old, new, "k").collect()] == [{"x": 2}]
    assert _rows(W.upsert(old.select("k"), new.select("k"), "k")) == [(None,)]


def test_upsert_table_survives_failed_write_and_half_swap(spark, tmp_path):
    path = str(tmp_path / "zones")
    W.upsert_table(spark, path, spark.createDataFrame([("a", 1)], "k string, v int"), "k")
    bad = spark.range(1).selectExpr("'a' AS k", "CAST(raise_error('stop') AS INT) AS v")
    with pytest.raises(PySparkException):
        W.upsert_table(spark, path, bad, "k")
    assert _rows(spark.read.parquet(path)) == [("a", 1)]
    (tmp_path / "zones").rename(tmp_path / "zones__previous")
    out = W.upsert_table(spark, path, spark.createDataFrame([("b", 2)], "k string, v int"), "k")
    assert _rows(out) == [("a", 1), ("b", 2)]
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(AnalysisException):
        W.upsert_table(spark, str(empty), spark.createDataFrame([("b", 2)], "k string, v int"), "k")


def test_registered_upsert_keeps_old_zones(spark):
    store = catalog._store(spark, SF)
    second = store.filter(f"`timestamp` >= TIMESTAMP_NTZ '{catalog.UPSERT_CUTOFF}' AND latitude >= {catalog.UPSERT_SOUTH}D")
    kept = store.select("geo_zone").distinct().exceptAll(second.select("geo_zone").distinct()).count()
    assert kept > 0
    assert catalog.q_zone_stats_upsert(spark, SF).count() == store.select("geo_zone").distinct().count()


@pytest.mark.parametrize("name", ["category_distribution", "complaint_status"])
def test_closed_shares_scan_once(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1, plan


def test_export_does_not_depend_on_order(spark):
    values = [40.1 + (i * 37 % 1000) * 0.005 for i in range(500)] + [60.3] * 7
    rows = [("z", "l", i % 2, 0, v) for i, v in enumerate(values)] + [("y", "l", 0, 0, 60.3)] * 3
    ddl = "geo_zone string, location_type string, hour long, day_of_week long, noise_level_db double"
    one = trends.export_aggregates(spark.createDataFrame(rows, ddl).coalesce(1))
    many = trends.export_aggregates(spark.createDataFrame(rows[::-1], ddl).repartition(7))
    assert _rows(one) == _rows(many)
    assert [r["std_dev_db"] for r in one.collect() if r["geo_zone"] == "y"] == [0.0]


def test_report_without_hours(spark):
    ddl = ("complaint_id string, reading_id long, `timestamp` timestamp_ntz, category string, "
           "estimated_noise_db double, hour long, day_of_week long, geo_zone string, status string")
    t = dt.datetime(2024, 1, 1, 3, 4, 5, 678901)
    rows = [("NC1", 1, t, "traffic", 80.0, 3, 0, "a", "Open"), ("NC2", 2, t, "traffic", 82.0, 3, 0, "a", "Open"),
            ("NC3", 3, None, None, 90.0, None, None, None, None)]
    c = spark.createDataFrame(rows, ddl)
    doc = report.report_document(c, c).first()
    flat = report.report_flat(c, c).first()
    assert dict(doc["hourly_distribution"]) == {3: 2}
    assert (flat["peak_hour"], flat["peak_count"], doc["insights"][1]["peak_count"]) == (3, 2, 2)
    assert doc["summary"]["date_range"]["start"] == flat["date_start"] == "2024-01-01 03:04:05.678901"
    assert report.report_flat(c.where("hour IS NULL"), c).first()["peak_count"] is None
    assert C.peak_hour(c).first()["peak_count"] == 2


def test_whole_time_is_parsed(spark):
    times = {"2022-10-17 09:18:17.134+08:00": dt.datetime(2022, 10, 17, 9, 18, 17, 134000),
             "2022-10-17T09:18:17+08:00": dt.datetime(2022, 10, 17, 9, 18, 17),
             "2022-10-17 09:18:17.123456789": dt.datetime(2022, 10, 17, 9, 18, 17, 123456),
             "2022-10-17 09:18:17": dt.datetime(2022, 10, 17, 9, 18, 17),
             "2022-10-17 09:18:17garbage": None, "2022-13-17 09:18:17": None, "": None}
    names = [f.name for f in RAW_SENSOR_SCHEMA.fields]
    raw = spark.createDataFrame([(t,) for t in times], "time string")
    raw = raw.selectExpr("*", *[f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
                                for f in RAW_SENSOR_SCHEMA.fields if f.name != "time"], "50.0D AS base").select(*names, "base")
    out = features.preprocess_raw(raw, "base")
    assert sorted(map(str, (r["time"] for r in out.collect()))) == sorted(map(str, times.values()))


def test_persistent_view_is_read_in_another_session(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.range(3).write.saveAsTable(name)
    try:
        for _ in range(2):
            W.create_persistent_view(spark, f"{name}_view", f"SELECT sum(id) AS total FROM {name}")
        assert spark.newSession().table(f"{name}_view").first()["total"] == 3
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}_view")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_replayed_batch_after_compaction(spark, tmp_path):
    readings = catalog._readings(spark, SF).drop("reading_id")
    parts, compacted = str(tmp_path / "parts"), str(tmp_path / "compacted")
    for i in (0, 1):
        S._write_batch_partials(parts)(readings.where(f"hour % 3 = {i}"), i)
    S.compact_partials(spark, parts, compacted)
    S._write_batch_partials(compacted)(readings.where("hour % 3 = 1"), 1)
    S._write_batch_partials(compacted)(readings.where("hour % 3 = 2"), 2)
    again = str(tmp_path / "again")
    S.compact_partials(spark, compacted, again)
    S._write_batch_partials(again)(readings.where("hour % 3 = 2"), 2)
    whole = {r["key"]: r["count"] for r in catalog.q_moments_merge(spark, SF).collect()}
    assert {r["key"]: r["count"] for r in S.merged_moments(spark, again).collect()} == whole
