"""The keyed table, distinct counts from bitmaps, and the uniform sample."""

import hashlib
import os
import random

import pytest

from quietude.operators import complaints, distinct
from quietude.sinks.keyed import KeyedTable


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_upsert_rewrites_only_the_buckets_it_hits(spark, tmp_out):
    kept = KeyedTable(spark, os.path.join(tmp_out, "t"), "k", buckets=32)
    first = spark.range(500).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    assert kept.upsert(first) == set(range(32))
    before = files(kept.path + "/data")
    hit = kept.upsert(spark.createDataFrame([("7", -7), ("new", -1)], "k string, v long"))
    assert 1 <= len(hit) <= 2 and before < files(kept.path + "/data")
    live = {os.path.relpath(f.removeprefix("file:"), kept.path) for f in kept.read().inputFiles()}
    assert {f for f in live if "v=1/" in f} == {os.path.relpath(f, kept.path) for f in before
                                               if int(f.rsplit("bucket=", 1)[1].split("/")[0]) not in hit}
    want = {str(i): i for i in range(500)} | {"7": -7, "new": -1}
    assert {r["k"]: r["v"] for r in kept.read().collect()} == want and kept.read().count() == 501
    assert kept.read(1).count() == 500  # the version before
    assert kept.vacuum() == [1] and kept.versions() == [2]
    assert {r["k"]: r["v"] for r in kept.read().collect()} == want
    assert kept.vacuum() == []


def test_keyed_table_against_a_dictionary(spark, tmp_out):
    rnd, want = random.Random(3), {}
    kept = KeyedTable(spark, os.path.join(tmp_out, "t"), ["a", "b"], buckets=5)
    for step in range(4):
        rows = [(rnd.choice([None, "x", "y", ""]), rnd.randint(0, 6), rnd.randint(0, 99), step) for _ in range(rnd.choice([1, 12]))]
        kept.upsert(spark.createDataFrame(rows, "a string, b int, at int, v int"), order="at")
        for key in {r[:2] for r in rows}:
            want[key] = max((r[2], r[3]) for r in rows if r[:2] == key)
        assert {(r["a"], r["b"]): (r["at"], r["v"]) for r in kept.read().collect()} == want
    again = spark.createDataFrame(rows, "a string, b int, at int, v int")
    kept.upsert(again, order="at")
    assert {(r["a"], r["b"]): (r["at"], r["v"]) for r in kept.read().collect()} == want
    assert kept.upsert(again.limit(0)) == set()
    # Another object with another number of buckets goes by the table's own.
    other = KeyedTable(spark, kept.path, ["a", "b"], buckets=99)
    other.upsert(spark.createDataFrame([(None, 0, 500, 9)], "a string, b int, at int, v int"))
    assert {(r["a"], r["b"]): r["v"] for r in other.read().collect()}[(None, 0)] == 9


def test_failed_upsert_leaves_the_table(spark, tmp_out):
    kept = KeyedTable(spark, os.path.join(tmp_out, "t"), "k", buckets=4)
    kept.upsert(spark.range(9).selectExpr("id AS k", "id AS v"))
    bad = spark.range(9).selectExpr("id AS k", "IF(id = 8, raise_error('stopped'), id + 1) AS v")
    with pytest.raises(Exception):
        kept.upsert(bad)
    assert kept.versions() == [1] and {r["v"] for r in kept.read().collect()} == set(range(9))
    kept.upsert(spark.range(9).selectExpr("id AS k", "id + 1 AS v"))
    assert {r["v"] for r in kept.read().collect()} == set(range(1, 10))


def test_new_columns_and_empty_start(spark, tmp_out):
    kept = KeyedTable(spark, os.path.join(tmp_out, "t"), "k", buckets=4)
    kept.upsert(spark.createDataFrame([], "k long, v long"))
    with pytest.raises(ValueError):
        kept.read()
    kept.upsert(spark.range(3).selectExpr("id AS k", "id AS v"))
    kept.upsert(spark.createDataFrame([(1, 5, "w")], "k long, v long, more string"))
    assert {r["k"]: (r["v"], r["more"]) for r in kept.read().collect()} == {0: (0, None), 1: (5, "w"), 2: (2, None)}


# --- distinct ids -------------------------------------------------------------

def test_bitmaps_equal_count_distinct(spark, tmp_out):
    rnd = random.Random(8)
    rows = [(f"p{rnd.randint(0, 900)}" if rnd.random() > .05 else None, f"2024-01-{rnd.randint(1, 20):02d}") for _ in range(6000)]
    df = spark.createDataFrame(rows, "p string, day string").selectExpr("p", "CAST(day AS TIMESTAMP_NTZ) AS `timestamp`").repartition(7)
    first, second = df.filter("day(`timestamp`) <= 12"), df.filter("day(`timestamp`) > 12")
    for i, part in enumerate((first, second)):  # the second load adds the ids that are new
        known = spark.read.parquet(f"{tmp_out}/ids0") if i else None
        distinct.numbered(part, "p", known).write.parquet(f"{tmp_out}/ids{i}")
        distinct.day_bitmaps(part, "p", spark.read.parquet(f"{tmp_out}/ids{i}")).write.parquet(f"{tmp_out}/days/load={i}")
    ids = spark.read.parquet(f"{tmp_out}/ids1").collect()
    assert len({r["number"] for r in ids}) == len(ids) == len({p for p, _ in rows if p})
    bitmaps = spark.read.parquet(f"{tmp_out}/days")
    seen = {}
    for p, day in rows:
        if p:
            seen.setdefault(int(day[-2:]), set()).add(p)
    assert distinct.merged(bitmaps).first()[0] == len(ids)
    for a, b in ((1, 20), (3, 3), (5, 13), (25, 30)):
        assert distinct.between(bitmaps, f"2024-01-{a:02d}", f"2024-01-{b:02d}").first()[0] == len(
            set().union(*[seen.get(d, set()) for d in range(a, b + 1)]))
    got = {r["date"].day: r["distinct_ids"] for r in distinct.trailing(bitmaps, 7).collect()}
    assert got == {d: len(set().union(*[seen.get(x, set()) for x in range(d - 6, d + 1)])) for d in seen}


# --- sample -------------------------------------------------------------------

def test_uniform_sample(spark):
    df = spark.range(3000).withColumnRenamed("id", "reading_id").repartition(6)

    def drawn(seed, n=100, rows=df):
        return {r["reading_id"] for r in complaints.sample_uniform(rows, n, seed).collect()}

    want = sorted(range(3000), key=lambda i: hashlib.md5(f"5:{i}".encode()).hexdigest())[:100]
    assert drawn(5) == set(want) and len(drawn(6)) == 100 and len(drawn(5) & drawn(6)) < 20
    assert drawn(5, 5000) == set(range(3000))
    halves = [complaints.sample_uniform(df.filter(f"reading_id % 2 = {i}"), 100, 5) for i in (0, 1)]
    assert drawn(5, rows=halves[0].unionByName(halves[1])) == set(want)
    hits = [0] * 10  # every row has the same chance
    for seed in range(12):
        for i in drawn(seed, 300):
            hits[i // 300] += 1
    assert all(280 < h < 440 for h in hits)
    assert drawn(1, 3, spark.createDataFrame([(None,), (1,)], "reading_id long")) == {None, 1}
