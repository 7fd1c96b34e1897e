"""A skewed fixture (one zone holds a third of the rows) against a pandas
brute force: the partial/final aggregates give the same answers as one
in-memory pass."""

import math
import random

import numpy as np
import pandas as pd
import pytest

from quietude.operators import stats, text, trends


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        zone = "hot" if i % 3 == 0 else f"z{rnd.randint(0, 40)}"
        rows.append((i, zone, rnd.choice(["Outdoor", "Indoor - Home", "Indoor - Office"]),
                     rnd.randint(0, 23), rnd.randint(0, 6), round(rnd.uniform(40, 105), 3),
                     rnd.choice(["a", "b", "c", "d"])))
    cols = ["reading_id", "geo_zone", "location_type", "hour", "day_of_week", "noise_level_db", "kind"]
    pdf = pd.DataFrame(rows, columns=cols)
    df = spark.createDataFrame(pdf).repartition(16).selectExpr(
        "*", "CASE WHEN noise_level_db < 50 THEN 'Quiet' WHEN noise_level_db < 60 THEN 'Moderate' "
             "WHEN noise_level_db < 70 THEN 'Noisy' WHEN noise_level_db < 80 THEN 'Very Noisy' "
             "ELSE 'Extremely Noisy' END AS noise_category")
    return df, pdf


def test_zone_statistics_matches_pandas(skewed):
    df, pdf = skewed
    got = {r["geo_zone"]: r for r in stats.zone_statistics(df).collect()}
    for zone, g in pdf.groupby("geo_zone"):
        x = g["noise_level_db"]
        r = got[zone]
        assert r["sample_count"] == len(x)
        assert abs(r["avg_noise_db"] - x.mean()) <= 0.006
        if len(x) > 1:
            assert abs(r["std_dev_db"] - x.std(ddof=1)) <= 0.006
    assert got["hot"]["sample_count"] == 1000


def test_hourly_percentiles_match_numpy(skewed):
    df, pdf = skewed
    got = {r["hour"]: r for r in trends.hourly_trends(df).collect()}
    for hour, g in pdf.groupby("hour"):
        x = g["noise_level_db"].to_numpy()
        assert abs(got[hour]["median_noise_db"] - np.percentile(x, 50)) <= 0.006
        assert abs(got[hour]["p95_noise_db"] - np.percentile(x, 95)) <= 0.006
        assert abs(got[hour]["std_dev_db"] - x.std(ddof=0)) <= 0.006


def test_group_mode_matches_pandas(skewed):
    df, pdf = skewed
    got = {r["geo_zone"]: (r["mode_value"], r["mode_count"])
           for r in stats.group_mode(df, ["geo_zone"], "kind").collect()}
    for zone, g in pdf.groupby("geo_zone"):
        counts = g["kind"].value_counts()
        top = counts.max()
        assert got[zone] == (min(counts[counts == top].index), top)


def test_grouping_sets_match_pandas(skewed):
    df, pdf = skewed
    pdf = pdf.assign(timestamp=pd.Timestamp("2024-01-01"))
    got = {r["key"]: r for r in stats.noise_grouping_sets(df.selectExpr("*", "TIMESTAMP_NTZ'2024-01-01' AS `timestamp`")).collect()}
    for zone, g in pdf.groupby("geo_zone"):
        r = got[f"zone:{zone}"]
        assert r["count"] == len(g) and abs(r["std_dev"] - g["noise_level_db"].std(ddof=0)) <= 0.006
    for (loc, hour), g in pdf.groupby(["location_type", "hour"]):
        assert got[f"location_hour:{loc}:{hour}"]["count"] == len(g)


def test_hot_word_counts(spark):
    lines = ["the " * 500 + "rare"] * 30 + ["other words here"] * 10
    df = spark.createDataFrame([(x,) for x in lines], "value string").repartition(8)
    got = {r["word"]: r["count"] for r in text.word_count(df).collect()}
    assert got["the"] == 15000 and got["rare"] == 30 and got["other"] == 10
    assert not any(math.isnan(v) for v in got.values())
