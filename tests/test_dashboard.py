"""The kept dashboard, the hourly table and loads that can be repeated."""

import os

import pytest

from quietude.operators import dashboard, trends
from quietude.sinks import writers as W
from quietude.sources import adapter
from quietude.sources.tables import table
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def readings(spark):
    return adapter.readings(table(spark, SF_SMALL, "events")).cache()


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(map(str, df.collect()))


def thirds(readings):
    day = "to_date(`timestamp`)"
    return [readings.filter(f"{day} < DATE'2024-01-11'"), readings.filter(f"{day} >= DATE'2024-01-11' AND reading_id % 2 = 0"),
            readings.filter(f"{day} >= DATE'2024-01-11' AND reading_id % 2 = 1")]


def test_dashboard_after_three_loads(spark, readings, tmp_out):
    path, want = os.path.join(tmp_out, "hist"), rows(trends.summary_view(readings))
    seen = set()
    for i, part in enumerate(thirds(readings)):
        dashboard.load_histograms(part, path, f"l{i}")
        assert seen < files(path)  # what earlier loads wrote is as it was
        seen = files(path)
    columns = trends.summary_view(readings).columns
    assert rows(dashboard.kept_summary(dashboard.histograms(spark, path)).select(*columns)) == want
    dashboard.load_histograms(thirds(readings)[1], path, "l1")  # run again: replaces itself
    assert len(files(path) - seen) > 0 and {f for f in seen if "l1" not in f} < files(path)
    name = f"board_{os.path.basename(tmp_out).replace('-', '_')}"
    dashboard.create_dashboard(spark, name, path)
    assert rows(spark.newSession().table(name).select(*columns)) == want
    dashboard.load_histograms(readings.limit(0), path, "l2")
    assert rows(spark.table(name).select(*columns)) == rows(trends.summary_view(readings.filter(
        "to_date(`timestamp`) < DATE'2024-01-11' OR reading_id % 2 = 0")).select(*columns))


def test_two_loads_of_one_day_equal_one_load_of_both(spark, readings, tmp_out):
    want = rows(trends.explode_category_map(trends.zone_hourly_stats(readings)))
    a, b, c = thirds(readings)
    parts, out = os.path.join(tmp_out, "parts"), os.path.join(tmp_out, "out")
    first = dashboard.load_hourly(a, parts, out, "a")
    before = files(out)
    days = dashboard.load_hourly(b, parts, out, "b")
    assert days == dashboard.load_hourly(c, parts, out, "c") and not set(first) & set(days)
    assert before < files(out)  # the first load's days keep their files
    columns = trends.zone_hourly_stats(readings).columns

    def table_rows():
        return rows(trends.explode_category_map(spark.read.schema(W.HOURLY_STATS_DDL).parquet(out).select(*columns)))

    assert table_rows() == want
    dashboard.load_hourly(c, parts, out, "c")
    assert table_rows() == want
    # A load that comes back without its days takes them along.
    dashboard.load_hourly(a.limit(0), parts, out, "a")
    assert table_rows() == rows(trends.explode_category_map(trends.zone_hourly_stats(b.unionByName(c))))


def test_merge_of_class_maps(spark):
    df = spark.createDataFrame([("a", {"x": 1, "y": 2}), ("a", {"y": 5}), ("a", None), ("b", {}), ("b", {"z": 1})], "k string, m map<string,long>")
    out = {r["k"]: r["m"] for r in df.groupBy("k").agg(dashboard.E(dashboard.merge_counts_sql("m", ["x", "y", "z"]) + " AS m")).collect()}
    assert out == {"a": {"x": 1, "y": 7}, "b": {"z": 1}}


def test_a_load_replaces_itself(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    for load_id, n in (("2024-01-01", 5), ("2024-01-02", 3), ("2024-01-01", 5), ("2024-01-02", 4)):
        W.write_load(spark.range(n).selectExpr("id", f"'{load_id}' AS day"), path, load_id)
    back = spark.read.schema("id long, day string, load_id string").parquet(path)
    assert sorted((r["day"], r["load_id"]) for r in back.collect()) == [("2024-01-01",) * 2] * 5 + [("2024-01-02",) * 2] * 4
    with pytest.raises(ValueError):
        W.write_load(spark.range(1), path, "../x")


def test_a_failed_load_leaves_the_table(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    W.write_load(spark.range(5).toDF("id"), path, "a")
    with pytest.raises(Exception):
        W.write_load(spark.range(5).selectExpr("IF(id = 4, raise_error('stopped'), id) AS id"), path, "a")
    assert spark.read.schema("id long, load_id string").parquet(path).count() == 5
    W.write_load(spark.range(6).toDF("id"), path, "a")
    assert spark.read.schema("id long, load_id string").parquet(path).count() == 6


def test_values_with_weights_and_nulls(spark):
    """Medians of even and odd counts, NULL keys, one value."""
    data = [("z", None, 1, 2, v) for v in (50.0, 50.0, 90.0, 40.0)] + [(None, "l", None, None, 81.0)] + [("z", "l", 1, 2, v) for v in (1.0, 2.0, 9.0)]
    r = spark.createDataFrame(data + [("z", "l", 1, 2, None)], "geo_zone string, location_type string, hour long, day_of_week long, noise_level_db double")
    r = r.selectExpr("*", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS `timestamp`")
    hist = dashboard.day_histograms(r)
    want = trends.summary_view(r)
    assert rows(dashboard.kept_summary(hist.unionByName(hist)).drop("total_measurements", "extreme_noise_events", "quiet_events")) == rows(
        trends.summary_view(r.unionByName(r)).drop("total_measurements", "extreme_noise_events", "quiet_events"))
    assert rows(dashboard.kept_summary(hist).select(*want.columns)) == rows(want)
