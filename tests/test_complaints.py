"""Complaint routing, weighted assignment, sampling and report invariants."""

import json

from pyspark.sql import functions as F

from quietude.operators import complaints as C
from quietude.operators import report
from quietude.sources import adapter
from quietude.sources.tables import table
from tests.conftest import SF_SMALL


def test_route_boundaries(spark):
    rows = [("Outdoor", 6), ("Outdoor", 7), ("Outdoor", 18), ("Outdoor", 19), ("Outdoor", 23),
            ("Outdoor", None), ("Indoor - Transport", 3), (None, 12)]
    df = spark.createDataFrame(rows, "loc string, hour long")
    out = [r["g"] for r in df.select(C.route_group("loc", "hour").alias("g")).collect()]
    assert out == ["night", "day", "day", "evening", "evening", "night", "traffic", "day"]


def test_weighted_pick_shares(spark):
    df = spark.range(0, 10000).withColumnRenamed("id", "reading_id")
    day = df.select(C.assigned_category("'day'").alias("c")).groupBy("c").count().collect()
    share = {r["c"]: r["count"] / 10000 for r in day}
    assert abs(share["construction"] - 0.5) < 0.01 and abs(share["industrial"] - 0.2) < 0.01
    st = {r["s"]: r["count"] / 10000
          for r in df.select(C.assigned_status().alias("s")).groupBy("s").count().collect()}
    assert abs(st["Open"] - 0.3) < 0.01 and abs(st["In Progress"] - 0.2) < 0.01
    # status does not follow the category bucket
    both = df.select(C.category_bucket("reading_id").alias("a"), C.status_bucket("reading_id").alias("b"))
    assert both.filter(F.col("a") == F.col("b")).count() < 300


def test_sample_falls_back_to_all_rows(spark):
    df = spark.createDataFrame([(i, 50.0 + (30.0 if i < 3 else 0.0)) for i in range(20)],
                               "reading_id long, noise_level_db double")
    assert C.sample_high_noise(df, n=2).count() == 2
    assert {r["noise_level_db"] for r in C.sample_high_noise(df, n=2).collect()} == {80.0}
    # only 3 rows above 70 -> 5 are drawn from all rows
    assert C.sample_high_noise(df, n=5).count() == 5
    assert C.sample_high_noise(df, n=5).filter("noise_level_db < 70").count() > 0


def test_report_invariants(spark):
    r = adapter.readings(table(spark, SF_SMALL, "events"))
    c = C.complaints(r, 500)
    doc = report.report_document(c, r, run_ts="2024-01-01T00:00:00").first()
    total = doc["summary"]["total_complaints"]
    assert total == 500 and doc["summary"]["total_sensors"] == r.count()
    for m in ("category_distribution", "hourly_distribution", "status_distribution"):
        assert sum(doc[m].values()) == total
    ins = doc["insights"]
    assert [i["type"] for i in ins] == ["Geographic Hotspot", "Temporal Pattern", "Complaint Category",
                                       "Response Efficiency"]
    unresolved = sum(v for k, v in doc["status_distribution"].items() if k in ("Open", "In Progress"))
    assert ins[3]["unresolved_count"] == unresolved
    flat = report.report_flat(c, r).first()
    assert json.loads(flat["category_distribution"]) == dict(doc["category_distribution"])
    assert flat["peak_hour"] == ins[1]["peak_hour"]


def test_complaint_ids(spark):
    r = adapter.readings(table(spark, SF_SMALL, "events"))
    ids = [x["complaint_id"] for x in C.complaints(r, 50).collect()]
    assert all(i.startswith("NC") and len(i) >= 8 for i in ids) and len(set(ids)) == 50


def test_sample_equals_brute_force(spark):
    r = adapter.readings(table(spark, SF_SMALL, "events"), with_zone=False)
    rows = [(x["reading_id"], x["noise_level_db"]) for x in r.select("reading_id", "noise_level_db").collect()]
    high = [i for i, db in rows if db is not None and db > C.HIGH_NOISE_DB]
    for n in (1, 200, len(high), len(high) + 1, len(rows), len(rows) + 5):
        pool = high if len(high) >= n else [i for i, _ in rows]
        want = sorted(pool, key=lambda i: ((i * 7919) % C.SAMPLE_MODULUS, i))[:n]
        assert [x["reading_id"] for x in C.sample_high_noise(r, n).collect()] == want
    assert C.sample_high_noise(r.limit(0), 5).count() == 0


def test_zone_free_queries_start_no_job(spark):
    from quietude.plans.catalog import QUERIES
    # Queries with percentiles search for ranks when they are built (tests/test_ranks.py).
    names = ["noise_category", "weekday_weekend", "location_analysis", "peak_hours_by_location",
             "category_distribution", "hourly_patterns", "readings_overview",
             "value_counts", "group_mode", "complaint_route", "weighted_assign", "complaints_by_hour",
             "complaints_by_weekday", "complaint_status", "peak_hour", "top_category", "unresolved_share"]
    sc = spark.sparkContext
    sc.setJobGroup("zone-free", "build only")
    try:
        for name in names:
            QUERIES[name](spark, SF_SMALL)
        assert list(sc.statusTracker().getJobIdsForGroup("zone-free")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
