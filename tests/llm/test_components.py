"""Components by alternating stars against a union-find."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quietude.llm import common, jaccard_join
from quietude.session import ensure_checkpoint_dir


def _union_find(edges):
    root = {}

    def find(n):
        root.setdefault(n, n)
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in root}


@pytest.mark.parametrize("edges", [
    [],
    [(1, 1)],
    [(1, 2), (2, 1), (1, 2)],
    [(9, 1), (9, 2), (9, 3), (9, 4)],
    [(i, i + 1) for i in range(20)],
    random.Random(3).sample([(a, b) for a in range(40) for b in range(a)], 30),
], ids=["none", "loop", "repeated", "hub", "chain", "random"])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "x long, y long")
    found = {r["node"]: r["root"] for r in jaccard_join.components(df).collect()}
    assert found == _union_find([e for e in edges if e[0] != e[1]])


def _folders(spark):
    return {f for f in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file://")) if f.startswith("quietude-")}


def test_components_create_no_files(spark):
    before = _folders(spark)
    roots = jaccard_join.components(spark.createDataFrame([(i, i + 1) for i in range(20)], "x long, y long"))
    assert {r["node"]: r["root"] for r in roots.collect()} == dict.fromkeys(range(21), 0)
    assert _folders(spark) == before


def test_near_dedup_writes_only_its_large_tables(spark, monkeypatch):
    names = []
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name, *more: names.append(name) or common.stored(df, name, *more))
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base), " ".join([*base[:39], "x"]), " ".join([*base[:38], "y", "z"]), " ".join(base[::-1]), " ".join(base), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = jaccard_join.keep_one(docs, percent=80, words=2)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 5]
    assert names == ["rows", "survey", "found", "buckets", "bins", "hub_pairs", "rooted", "open"]


def test_held_rows_stay_what_they_are(spark):
    key = common.SHUFFLE_CLEANUP
    before = spark.conf.get(key), spark.conf.get(common.ARROW_BYTES), _folders(spark)
    rows = common.held(spark.range(100).repartition(3).withColumn("draw", F.rand()), 1 << 20)
    first = sorted((r.id, r.draw) for r in rows.collect())
    assert [i for i, _ in first] == list(range(100))
    assert sorted((r.id, r.draw) for r in rows.collect()) == first
    assert "Range" not in rows._jdf.queryExecution().toString()
    assert (spark.conf.get(key), spark.conf.get(common.ARROW_BYTES), _folders(spark)) == before
    none = common.held(spark.range(0))
    assert none.count() == 0 and none.columns == ["id"]
