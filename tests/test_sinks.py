"""Sinks: write, read back, compare (including NULLs and quotes)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quietude.operators import complaints as C
from quietude.operators import features, report, stats
from quietude.sinks import writers as W
from quietude.sources import adapter
from quietude.sources.tables import create_readings_table, readings_tsv_as_text, table
from tests.conftest import SF_SMALL


def _readings(spark):
    return adapter.readings(table(spark, SF_SMALL, "events"), keep_id=False)


def test_key_value_text_fails_if_exists(spark, tmp_out):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    path = os.path.join(tmp_out, "kv")
    W.write_key_value_text(df, path, "k", "v")
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["a\t1", "b\t2"]
    with pytest.raises(Exception):
        W.write_key_value_text(df, path, "k", "v")


def test_tsv_export_and_external_table(spark, tmp_out):
    r = _readings(spark)
    path = os.path.join(tmp_out, "tsv")
    W.export_readings_tsv(r, path)
    # The line parser splits on tabs only (quoted fields stay quoted, as in
    # the reference mapper); every other column round-trips exactly.
    cols = [c for c in r.columns if c != "noise_kind"]
    back = features.parse_readings_lines(spark.read.text(path)).select(*cols)
    assert back.exceptAll(r.select(*cols)).count() == 0 and r.select(*cols).exceptAll(back).count() == 0
    # The CSV reader unescapes quotes: noise_kind comes back whole.
    texts = readings_tsv_as_text(spark, path)
    assert texts.columns[0] == "time" and texts.count() == r.count()
    assert sorted(x["q_noise_kind"] for x in texts.collect()) == sorted(x["noise_kind"] for x in r.collect())
    create_readings_table(spark, "noise_sensor_data_t", path)
    assert spark.table("noise_sensor_data_t").count() == r.count()
    spark.sql("DROP TABLE IF EXISTS noise_sensor_data_t")


def test_csv_quotes_and_nulls(spark, tmp_out):
    df = spark.createDataFrame([('say "hi", ok', None), ("plain", 2.5)], "s string, x double")
    path = os.path.join(tmp_out, "csv")
    W.write_csv(df, path)
    back = spark.read.options(header=True, escape='"').schema("s string, x double").csv(path)
    assert sorted(back.collect(), key=lambda r: r["s"]) == sorted(df.collect(), key=lambda r: r["s"])


def test_stats_tsv_sorted(spark, tmp_out):
    s = stats.noise_grouping_sets(adapter.readings(table(spark, SF_SMALL, "events")))
    path = os.path.join(tmp_out, "stats")
    W.write_stats_tsv(s, path)
    back = spark.read.options(sep="\t", header=True).csv(path)
    assert back.columns == ["key", "count", "mean_db", "std_dev", "min_db", "max_db"]
    assert back.count() == s.count()


def test_partitioned_parquet_with_map(spark, tmp_out):
    from quietude.operators import trends
    z = trends.zone_hourly_stats(_readings(spark))
    path = os.path.join(tmp_out, "hourly")
    W.write_partitioned_parquet(z, path)
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["noise_category_distribution"] == "map<string,bigint>"
    assert back.count() == z.count()
    one = back.select("date_partition").first()["date_partition"]
    assert back.filter(F.col("date_partition") == one).count() > 0
    assert os.path.isdir(os.path.join(path, f"date_partition={one}"))


def test_directory_export(spark, tmp_out):
    from quietude.operators import trends
    trends.export_aggregates(_readings(spark)).createOrReplaceTempView("export_v")
    path = os.path.join(tmp_out, "dir_export")
    W.insert_overwrite_directory(spark, "export_v", path)
    assert spark.read.csv(path).count() == spark.table("export_v").count()


def test_append_twice_duplicates(spark, tmp_out):
    df = spark.createDataFrame([(1,), (2,)], "a long")
    path = os.path.join(tmp_out, "app")
    W.append_table(df, path)
    W.append_table(df, path)
    assert spark.read.parquet(path).count() == 4


def test_upsert_replaces_and_is_idempotent(spark, tmp_out):
    old = spark.createDataFrame([("z1", 1.0), ("z2", 2.0)], "geo_zone string, v double")
    new = spark.createDataFrame([("z2", 20.0), ("z3", 30.0)], "geo_zone string, v double")
    path = os.path.join(tmp_out, "zones")
    W.upsert_table(spark, path, old, "geo_zone")
    once = {r["geo_zone"]: r["v"] for r in W.upsert_table(spark, path, new, "geo_zone").collect()}
    twice = {r["geo_zone"]: r["v"] for r in W.upsert_table(spark, path, new, "geo_zone").collect()}
    assert once == twice == {"z1": 1.0, "z2": 20.0, "z3": 30.0}


def test_json_lines_keep_nulls(spark, tmp_out):
    df = spark.createDataFrame([(1, None), (2, "x")], "id long, s string")
    path = os.path.join(tmp_out, "jsonl")
    W.write_json_lines(df, path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert {"id": 1, "s": None} in lines


def test_report_json(spark, tmp_out):
    r = adapter.readings(table(spark, SF_SMALL, "events"))
    doc = report.report_document(C.complaints(r, 100), r, run_ts="2024-01-01T00:00:00")
    path = os.path.join(tmp_out, "report")
    W.write_report_json(doc, path)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    obj = json.loads(open(os.path.join(path, files[0])).read())
    assert obj["summary"]["total_complaints"] == 100
    assert all(isinstance(k, str) for k in obj["hourly_distribution"])  # int keys -> text
    assert len(obj["insights"]) == 4


def test_view_and_create_if_absent(spark, tmp_out):
    from quietude.operators import trends
    W.create_view(spark, "noise_pollution_summary", trends.summary_view(_readings(spark)))
    assert spark.table("noise_pollution_summary").count() > 0
    loc = os.path.join(tmp_out, "zs")
    for _ in range(2):
        W.create_table_if_absent(spark, "zone_statistics_t", "geo_zone STRING, avg_noise_db DOUBLE",
                                 location=loc)
    assert spark.table("zone_statistics_t").columns == ["geo_zone", "avg_noise_db"]
    spark.sql("DROP TABLE IF EXISTS zone_statistics_t")


def test_declared_partitioned_table_insert(spark, tmp_out):
    from quietude.operators import trends
    loc = os.path.join(tmp_out, "hourly_table")
    W.create_table_if_absent(spark, "noise_statistics_hourly_t", W.HOURLY_STATS_DDL,
                             partitioned_by="date_partition", location=loc)
    z = trends.zone_hourly_stats(_readings(spark))
    W.insert_into_table(z, "noise_statistics_hourly_t")
    W.insert_into_table(z, "noise_statistics_hourly_t")  # replaces the same partitions
    back = spark.table("noise_statistics_hourly_t")
    assert back.count() == z.count()
    assert dict(back.dtypes)["noise_category_distribution"] == "map<string,bigint>"
    one = back.select("date_partition").first()["date_partition"]
    assert back.filter(F.col("date_partition") == one).count() == z.filter(F.col("date_partition") == one).count()
    spark.sql("DROP TABLE IF EXISTS noise_statistics_hourly_t")


def test_partition_pruning_on_date(spark, tmp_out):
    from quietude.operators import trends
    path = os.path.join(tmp_out, "hourly_pruned")
    W.write_partitioned_parquet(trends.zone_hourly_stats(_readings(spark)), path)
    day = spark.read.parquet(path).select("date_partition").first()["date_partition"]
    q = spark.read.parquet(path).filter(F.col("date_partition") == day).select("geo_zone", "avg_noise_db")
    plan = q._jdf.queryExecution().executedPlan().toString()
    # partition values are typed on read (a yyyy-MM-dd folder reads back as DATE)
    assert "PartitionFilters: [isnotnull(date_partition" in plan and str(day) in plan
    assert "ReadSchema: struct<geo_zone:string,avg_noise_db:double>" in plan
    assert q.count() == spark.read.parquet(path).filter(F.col("date_partition") == day).count()
