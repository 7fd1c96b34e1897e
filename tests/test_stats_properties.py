"""Properties of the statistics jobs on the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from quietude.operators import stats, trends
from quietude.sources import adapter
from quietude.sources.tables import table
from tests.conftest import SF_SMALL


def _readings(spark):
    return adapter.readings(table(spark, SF_SMALL, "events"))


def test_merge_of_partials_equals_grouping_sets(spark):
    r = _readings(spark)
    direct = {row["key"]: tuple(row[1:]) for row in stats.noise_grouping_sets(r).collect()}
    # partials by day, by hour of day and by reading-id parity: any split merges to the same
    for split in (("date",), ("hour_split",), ("parity",)):
        rr = r.withColumn("hour_split", F.col("hour")).withColumn("parity", F.col("reading_id") % 2)
        merged = stats.moments_merge(stats.moments_partial(rr, split_cols=split))
        got = {row["key"]: tuple(row[1:]) for row in merged.collect()}
        assert got.keys() == direct.keys()
        for k, (n, mean, std, lo, hi) in direct.items():
            gn, gmean, gstd, glo, ghi = got[k]
            assert gn == n and abs(gmean - mean) <= 0.011 and abs(gstd - std) <= 0.011
            assert (glo, ghi) == (lo, hi)


def test_five_key_kinds_present(spark):
    keys = [r["key"] for r in stats.noise_grouping_sets(_readings(spark)).collect()]
    assert {k.split(":")[0] for k in keys} == {"zone_hour", "location_hour", "day", "hour", "zone"}
    assert keys == sorted(keys)  # text order: 'hour:10' < 'hour:2'


def test_category_shares_sum_to_100(spark):
    rows = trends.category_distribution(_readings(spark)).collect()
    assert abs(sum(r["percentage"] for r in rows) - 100.0) < 0.05
    assert sum(r["count"] for r in rows) == _readings(spark).count()


def test_zone_statistics_single_row_std_is_null(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 60.0), ("b", 62.0), ("c", 0.0)],
                               "geo_zone string, noise_level_db double")
    out = {r["geo_zone"]: r for r in stats.zone_statistics(df, run_ts="2024-01-01T00:00:00").collect()}
    assert out["a"]["std_dev_db"] is None and out["a"]["sample_count"] == 1
    assert out["b"]["std_dev_db"] == 1.41
    assert out["c"]["avg_noise_db"] is None  # a zero is stored as NULL
    assert out["a"]["last_updated"] == "2024-01-01T00:00:00"


def test_group_mode_ties_to_lowest(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", "a"), ("h", "z"), ("h", None)],
                               "grp string, v string")
    out = {r["grp"]: (r["mode_value"], r["mode_count"]) for r in stats.group_mode(df, ["grp"], "v").collect()}
    assert out == {"g": ("a", 2), "h": ("z", 1)}


def test_location_mode_matches_group_mode(spark):
    r = _readings(spark)
    la = {x["location_type"]: x["most_common_category"] for x in trends.location_analysis(r).collect()}
    gm = {x["location_type"]: x["mode_value"]
          for x in stats.group_mode(r, ["location_type"], "noise_category").collect()}
    assert la == gm


def test_percentiles_exact_interpolated(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "noise_level_db double")
    r = stats.noise_describe(df).first()
    assert (r["p25"], r["p50"], r["p75"]) == (1.75, 2.5, 3.25)


def test_value_counts_order_and_share(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "c string")
    rows = stats.value_counts(df, "c").collect()
    assert [(r["c"], r["count"], r["percentage"]) for r in rows] == [("y", 2, 66.67), ("x", 1, 33.33)]


def test_hotspot_threshold_filter(spark):
    df = spark.createDataFrame([("a", 80.0, 10), ("b", 74.99, 50), ("c", 90.0, 9)],
                               "geo_zone string, avg_noise_db double, sample_count long")
    assert [r["geo_zone"] for r in stats.hotspots_threshold(df).collect()] == ["a"]
