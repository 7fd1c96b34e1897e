"""Feature derivation: noise classes, offsets, clipping, bins, parsing, ids."""

import datetime as dt

from quietude.functions import expr as X
from quietude.operators import features


def test_noise_category_boundaries(spark):
    vals = [None, 49.99, 50.0, 59.99, 60.0, 69.99, 70.0, 79.99, 80.0, 105.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = [r["c"] for r in df.select(X.noise_category("x").alias("c")).collect()]
    assert out == ["Unknown", "Quiet", "Moderate", "Moderate", "Noisy", "Noisy", "Very Noisy",
                   "Very Noisy", "Extremely Noisy", "Extremely Noisy"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (10.0,), (200.0,), (55.5,)], "x double")
    out = [r["c"] for r in df.select(X.clip_keep_null("x").alias("c")).collect()]
    assert out == [None, 40.0, 105.0, 55.5]


def test_offsets_then_override_then_clip(spark):
    rows = [("Indoor - Home", 50.0, None), ("Outdoor", 100.0, None), ("Indoor - Transport", 60.0, 42.0),
            ("Somewhere", 61.0, None), (None, 35.0, None)]
    df = spark.createDataFrame(rows, "loc string, base double, measured double")
    out = [r["n"] for r in features.with_noise_adjusted(df, "base", "loc", "measured", "n").collect()]
    assert out == [40.0, 105.0, 42.0, 61.0, 40.0]


def test_geo_bins_right_closed(spark):
    # 0..10 in 10 bins: edges at 1, 2, ... 9; an edge value belongs to the lower bin
    vals = [0.0, 0.5, 1.0, 1.0000001, 5.0, 9.0, 9.5, 10.0, None]
    df = spark.createDataFrame([(v, 0.0) for v in vals], "latitude double, longitude double")
    out = [r["geo_zone"] for r in features.with_geo_zone(df).collect()]
    lat = [z.split("_")[0] for z in out]
    assert lat == ["0.0", "0.0", "0.0", "1.0", "4.0", "8.0", "9.0", "9.0", "nan"]
    # constant longitude -> middle bin
    assert {z.split("_")[1] for z in out} == {"4.0"}


def test_geo_bins_match_edge_count(spark):
    """The guess-and-correct bin equals counting exceeded edges."""
    import random
    rnd = random.Random(7)
    vals = [rnd.uniform(1.2, 1.48) for _ in range(3000)] + [1.2 + k * 0.028 for k in range(11)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    lo, hi = min(vals), max(vals)
    w = (hi - lo) / 10.0
    expect = [sum(1 for k in range(1, 10) if v > lo + k * w) for v in vals]
    got = [r["b"] for r in df.select(X.equal_width_bin("x", lo, hi).alias("b")).collect()]
    assert got == expect


def test_all_null_axis_is_nan(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "latitude double, longitude double")
    assert {r["geo_zone"] for r in features.with_geo_zone(df).collect()} == {"nan_nan"}


def test_time_features_local_clock(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 10, 17, 9, 18, 17),)], "timestamp timestamp_ntz")
    r = features.with_time_features(df).first()
    assert (r["hour"], r["day_of_week"], r["date"]) == (9, 0, dt.date(2022, 10, 17))


def test_parse_tolerant(spark):
    good = "\t".join(["2024-01-01 09:00:00", "7", "1.2", "103.6", "55.5", "Moderate", "Outdoor",
                      "k", "9", "0", "0.0_0.0"])
    blank_time = "\t".join(["", "7", "1.2", "103.6", "55.5", "Moderate", "Outdoor", "k", "9", "0", "0.0_0.0"])
    rows = [
        "\t".join(["time"] + ["x"] * 10),       # header
        good,
        good.replace("\t55.5\t", "\t\t"),        # blank noise
        good.replace("\t55.5\t", "\tloud\t"),    # unparseable noise
        good.replace("\t9\t0\t", "\tnine\t0\t"),  # unparseable hour
        "a\tb\tc",                               # too short
        blank_time,                              # strip eats the leading tab -> 10 fields
        "  " + good + "  ",                      # surrounding blanks stripped
    ]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    out = features.parse_readings_lines(df).collect()
    assert len(out) == 2
    r = out[0]
    assert r["noise_level_db"] == 55.5 and r["hour"] == 9 and r["timestamp"] == dt.datetime(2024, 1, 1, 9)


def test_tsv_round_trip(spark):
    from quietude.sources import adapter
    from quietude.sources.tables import table
    from tests.conftest import SF_SMALL
    r = adapter.readings(table(spark, SF_SMALL, "events"), keep_id=False)
    back = features.parse_readings_lines(features.readings_as_tsv_lines(r))
    assert back.exceptAll(r).count() == 0 and r.exceptAll(back).count() == 0


def test_zero_pad_keeps_long_ids(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n long")
    out = [r["i"] for r in df.select(X.zero_pad_id("NC", "n").alias("i")).collect()]
    assert out == ["NC000007", "NC1234567"]


def test_round_half_up_ties(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (2.675,)], "x double")
    out = [r["r"] for r in df.select(X.round_half_up("x").alias("r")).collect()]
    assert out == [1.01, 0.13, 2.68]


def test_day_type_null_is_weekday(spark):
    df = spark.createDataFrame([(None,), (5,), (6,), (4,)], "d long")
    out = [r["t"] for r in df.select(X.day_type("d").alias("t")).collect()]
    assert out == ["Weekday", "Weekend", "Weekend", "Weekday"]


def test_store_load_requires_coordinates(spark):
    df = spark.createDataFrame([(50.0, 1.0, 2.0), (None, 1.0, 2.0), (50.0, None, 2.0)],
                               "noise_level_db double, latitude double, longitude double")
    assert features.readings_complete(df).count() == 1


def test_preprocess_raw_csv(spark, tmp_out):
    import os
    from quietude.sources.tables import raw_sensor_csv
    csv = os.path.join(tmp_out, "raw.csv")
    with open(csv, "w") as f:
        # columns in another order than the job's, plus unused ones
        f.write("extra,id_participant,time,ws_latitude,ws_longitude,q_location,q_noise_kind,q_noise_nearby,"
                "ts_heart_rate,ts_audio_exposure_environment\n")
        f.write('x,p1,2022-10-17 09:18:17.134000+08:00,1.30,103.8,Outdoor,"Traffic, ""heavy""",yes,70,\n')
        f.write("x,p2,2022-10-18 23:05:00+08:00,,,Indoor - Home,Quiet,no,60,88.5\n")
        f.write("x,p3,,1.35,103.9,Outdoor,k,no,60,\n")          # NULL time: dropped
        f.write("x,p4,not a time,1.40,104.0,Somewhere,k,no,60,\n")  # unparseable: kept, NULL time
    raw = raw_sensor_csv(spark, csv).withColumn("base", X.E("CAST(60.0 AS DOUBLE)"))
    out = {r["id_participant"]: r for r in features.preprocess_raw(raw, "base").collect()}
    assert set(out) == {"p1", "p2", "p4"}
    p1, p2, p4 = out["p1"], out["p2"], out["p4"]
    assert p1["time"] == dt.datetime(2022, 10, 17, 9, 18, 17, 134000)   # local wall clock
    assert (p1["hour"], p1["day_of_week"], p1["noise_level_db"]) == (9, 0, 70.0)   # 60 + 10 outdoor
    assert p1["q_noise_kind"] == 'Traffic, "heavy"'
    assert p2["noise_level_db"] == 88.5 and p2["noise_category"] == "Extremely Noisy"  # measured wins
    assert p2["geo_zone"].startswith("nan_") and p2["hour"] == 23
    assert p4["time"] is None and p4["hour"] is None and p4["noise_level_db"] == 60.0
    renamed = features.rename_to_table(features.preprocess_raw(raw, "base"))
    assert {"timestamp", "participant_id", "latitude", "location_type"} <= set(renamed.columns)
    stored = features.store_coerce(features.readings_complete(renamed.withColumnRenamed("ws_longitude", "longitude")))
    assert dict(stored.dtypes)["hour"] == "bigint"


def test_cluster_settings_scale_with_input():
    from quietude.session import cluster_settings
    small = cluster_settings(10 << 30, 64)
    big = cluster_settings(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # 2x cores floor
    assert int(big["spark.sql.shuffle.partitions"]) == 819_200        # capped
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_raw_csv_bad_number_is_null(spark, tmp_out):
    from quietude.sources.schemas import RAW_SENSOR_SCHEMA
    from quietude.sources.tables import raw_sensor_csv
    names = [f.name for f in RAW_SENSOR_SCHEMA.fields]
    number = next(f.name for f in RAW_SENSOR_SCHEMA.fields if f.dataType.typeName() == "double")
    with open(f"{tmp_out}/raw.csv", "w") as out:
        out.write(",".join(names) + "\n" + ",".join("n/a" if n == number else "" for n in names) + "\n")
    assert raw_sensor_csv(spark, f"{tmp_out}/raw.csv").collect()[0][number] is None


def test_unknown_hour_stays_unknown(spark):
    from quietude.operators import complaints as C
    c = spark.createDataFrame([(None,), (None,), (3,)], "hour bigint")
    assert [r.hour for r in C.complaints_by_hour(c).collect()] == [3]
    assert C.peak_hour(c).first().peak_hour == 3


def test_no_master_is_chosen_for_the_launcher():
    import inspect
    from quietude import session
    assert "local[*]\")" not in inspect.getsource(session.get_session)
