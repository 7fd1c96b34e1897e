"""End-to-end jobs write every output and agree with the operators."""

import json
import os

from quietude.plans import jobs as P
from quietude.sources import adapter
from quietude.sources.tables import table
from tests.conftest import SF_SMALL


def _write_lines(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_line_jobs(spark, tmp_out):
    src = os.path.join(tmp_out, "input.txt")
    _write_lines(src, ["hadoop big data hadoop", "big data analytics", "hadoop analytics"])
    P.word_count_job(spark, src, os.path.join(tmp_out, "wc"))
    assert sorted(r["value"] for r in spark.read.text(os.path.join(tmp_out, "wc")).collect()) == \
        ["analytics\t2", "big\t2", "data\t2", "hadoop\t3"]
    P.keyword_search_job(spark, src, os.path.join(tmp_out, "ks"))
    assert sorted(r["value"] for r in spark.read.text(os.path.join(tmp_out, "ks")).collect()) == \
        ["Found\thadoop analytics", "Found\thadoop big data hadoop"]
    students = os.path.join(tmp_out, "students.txt")
    _write_lines(students, ["1 Rahul 85", "2 Aman 90", "3 Zaid 75"])
    P.sort_by_name_job(spark, students, os.path.join(tmp_out, "sorted"))
    assert sorted(r["value"] for r in spark.read.text(os.path.join(tmp_out, "sorted")).collect()) == \
        ["Aman\t2 Aman 90", "Rahul\t1 Rahul 85", "Zaid\t3 Zaid 75"]


def test_preprocess_then_signal(spark, tmp_out):
    raw = os.path.join(tmp_out, "raw.csv")
    rows = ["time,id_participant,ws_latitude,ws_longitude,q_location,q_noise_kind,q_noise_nearby,"
            "ts_audio_exposure_environment,ts_heart_rate,base_db"]
    for i in range(40):
        loc = ["Outdoor", "Indoor - Home", "Indoor - Transport", ""][i % 4]
        rows.append(f"2023-0{1 + i % 3}-1{i % 10} {i % 24:02d}:00:00+08:00,p{i % 5},{1.2 + i * 0.01},"
                    f"{103.6 + i * 0.02},{loc},k{i % 3},no,,70,{45 + i}")
    _write_lines(raw, rows)
    readings = P.preprocessing_job(spark, raw, "base_db", tmp_out)
    assert readings.count() == 40
    result = P.signal_processing_job(spark, os.path.join(tmp_out, "noise_data_for_hdfs"), tmp_out)
    kinds = {r["key"].split(":")[0] for r in result.collect()}
    assert kinds == {"zone_hour", "location_hour", "day", "hour", "zone"}
    back = spark.read.options(sep="\t", header=True).csv(os.path.join(tmp_out, "mapreduce_results"))
    assert back.count() == result.count()
    assert spark.read.parquet(os.path.join(tmp_out, "raw_faults")).count() == 0


def test_preprocess_quarantines(spark, tmp_out):
    raw = os.path.join(tmp_out, "raw.csv")
    _write_lines(raw, ["extra,time,id_participant,ws_latitude,ws_longitude,q_location,q_noise_kind,q_noise_nearby,"
                       "ts_audio_exposure_environment,ts_heart_rate,base_db",
                       "e,2023-01-02 10:00:00+08:00,p,1.2,103.6,Outdoor,k,no,,70,50", "e,,p,1.2,103.6,Outdoor,k,no,,70,50",
                       "e,yesterday,p,1.2,103.6,Outdoor,k,no,,70,50", "e,2023-01-02 10:00:00,p,x,103.6,Outdoor,k,no,loud,70,50", "cut,short"])
    readings = P.preprocessing_job(spark, raw, "base_db", tmp_out)
    assert sorted(str(r["timestamp"]) for r in readings.collect()) == ["2023-01-02 10:00:00", "2023-01-02 10:00:00", "None"]
    faults = {(r["column_name"], r["reason"], r["text"], r["rejected"]) for r in spark.read.parquet(os.path.join(tmp_out, "raw_faults")).collect()}
    assert faults == {("time", "missing", None, True), ("time", "not a time", "yesterday", False), ("ws_latitude", "not a number", "x", False),
                      ("ts_audio_exposure_environment", "not a number", "loud", False), (None, "malformed line", "cut,short", True)}


def test_storage_job_can_be_repeated(spark, tmp_out):
    readings = P.materialise(adapter.readings(table(spark, SF_SMALL, "events")), os.path.join(tmp_out, "readings"))
    half = [readings.filter("reading_id % 2 = 0"), readings.filter("reading_id % 2 = 1")]
    for load_id, rows in (("l1", half[0]), ("l2", half[1]), ("l1", half[0])):
        out = P.storage_job(spark, rows, os.path.join(tmp_out, "store"), run_ts="t", load_id=load_id)
    assert out["dataset"].first()["total_records"] == readings.filter("latitude IS NOT NULL").count()
    hourly = spark.read.parquet(os.path.join(tmp_out, "store", "noise_statistics_hourly"))
    assert hourly.agg({"sample_count": "sum"}).first()[0] == readings.filter("noise_level_db IS NOT NULL").count()


def test_noise_jobs(spark, tmp_out):
    readings = P.materialise(adapter.readings(table(spark, SF_SMALL, "events")),
                             os.path.join(tmp_out, "readings"))
    P.trend_queries_job(spark, readings, tmp_out)
    for name in P.TREND_QUERIES:
        assert os.path.isdir(os.path.join(tmp_out, name))
    assert spark.table("noise_pollution_summary").count() > 0
    assert spark.read.csv(os.path.join(tmp_out, "mongodb_export")).count() > 0
    rolled = os.path.join(tmp_out, "rolled")
    P.trend_queries_job(spark, readings, rolled, use_rollup=True)
    direct = spark.read.options(header=True).csv(os.path.join(tmp_out, "query9_category_distribution"))
    via = spark.read.options(header=True).csv(os.path.join(rolled, "query9_category_distribution"))
    assert sorted(r["count"] for r in direct.collect()) == sorted(r["count"] for r in via.collect())
    out = P.storage_job(spark, readings, os.path.join(tmp_out, "store"), run_ts="2024-02-01T00:00:00")
    ds = out["dataset"].first()
    assert ds["total_records"] == readings.filter("latitude IS NOT NULL").count()
    doc = P.complaints_job(spark, readings, tmp_out, run_ts="2024-02-01T00:00:00").first()
    assert doc["summary"]["total_complaints"] == readings.filter("noise_level_db > 70").count()
    assert spark.read.options(header=True).csv(os.path.join(tmp_out, "public_complaints")).count() == 500
    files = [f for f in os.listdir(os.path.join(tmp_out, "complaint_report")) if f.endswith(".json")]
    obj = json.loads(open(os.path.join(tmp_out, "complaint_report", files[0])).read())
    assert obj["generated_at"] == "2024-02-01T00:00:00" and len(obj["insights"]) == 4


def test_complaints_without_ids(spark, tmp_out):
    readings = adapter.readings(table(spark, SF_SMALL, "events"), keep_id=False)
    P.complaints_job(spark, readings, tmp_out, run_ts="t", n=50)
    sample = spark.read.options(header=True).csv(os.path.join(tmp_out, "public_complaints"))
    assert sample.count() == sample.select("complaint_id").distinct().count() == 50
