"""Buckets that hubs leave open: many members, and blocks of a large bucket."""

import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from quietude.llm import common, jaccard_join
from tests.llm.test_operators import brute_links, words


def test_open_bucket_of_many_members_emits_only_near_pairs():
    rng = np.random.default_rng(5)
    count, size, t = 20_000, 60, jaccard_join.Threshold(80)
    sets = [np.unique(rng.integers(1, 1 << 63, size, dtype=np.uint64)) for _ in range(count)]
    near = [(7, 15_000), (123, 124), (0, 19_999)]
    for a, b in near:
        sets[b] = np.unique(np.concatenate([sets[a][:-1], sets[b][:1]]))
    rows = {"key": [1] * count, "node": [b"%05d" % i for i in range(count)], "n": [len(s) for s in sets], "pos": [0] * count,
            "root": [b"%05d" % i for i in range(count)], "block": [0] * count, "lo": [0] * count, "hi": [0] * count,
            "sketch": [jaccard_join._sketch(s) for s in sets]}
    batch = pa.RecordBatch.from_pydict(rows)
    parts = [batch.slice(lo, 10_000) for lo in range(0, count, 10_000)]
    start = time.time()
    got = {(x, y) for b in jaccard_join._unconnected(t, 0)(iter(parts)) for x, y in zip(*(c.to_pylist() for c in b.columns))}
    assert time.time() - start < 120
    assert {(b"%05d" % a, b"%05d" % b) for a, b in near} <= got
    assert len(got) < 100  # of 199,990,000 pairs


def test_pairs_of_an_open_bucket_are_tested_a_few_at_a_time():
    rng = np.random.default_rng(8)
    count, t = 3000, jaccard_join.Threshold(80)
    sets = [np.unique(rng.integers(1, 1 << 63, 60, dtype=np.uint64)) for _ in range(count)]
    sets[2999] = np.unique(np.concatenate([sets[0][:-1], sets[1][:1]]))
    nodes = [b"%05d" % i for i in range(count)]
    batch = pa.RecordBatch.from_pydict({
        "key": [1] * count, "node": nodes, "n": [len(s) for s in sets], "pos": [0] * count, "root": nodes, "block": [0] * count,
        "lo": [0] * count, "hi": [0] * count, "sketch": [jaccard_join._sketch(s) for s in sets]})
    tracemalloc.start()
    got = {(x, y) for b in jaccard_join._unconnected(t, 0)(iter([batch])) for x, y in zip(*(c.to_pylist() for c in b.columns))}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (nodes[0], nodes[2999]) in got
    assert peak < 24 << 20  # all columns and the arrays of 65,536 pairs; those of a million took over 100 MB


def test_sketches_of_linked_sets_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(6)
    for n in (1, 5, 300, 5000):
        x = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate([x[n // 5:], rng.integers(1, 1 << 63, n // 7 + 1, dtype=np.uint64)])
        bits = [np.frombuffer(jaccard_join._sketch(s), np.uint8) for s in (x, y)]
        assert int(np.bitwise_count(bits[0] ^ bits[1]).sum()) <= len(np.setxor1d(x, y))


@pytest.mark.parametrize("block", [1, 3])
def test_blocks_of_a_bucket_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    base, other = words(30, 9).split(), words(30, 11).split()
    texts = [" ".join([*b[:k], "new", *b[k:]]) for b in (base, other) for k in range(0, 30, 4)]
    texts += [" ".join(b[:k]) for b in (base, other) for k in range(20, 31)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(docs, percent=80, words=2).collect()}
    assert got == brute_links(rows, 80, 2)


def test_discarded_table_is_deleted(spark):
    df = common.stored(spark.range(5).toDF("id"), "gone")
    path = spark._jvm.org.apache.hadoop.fs.Path(common._PATHS[df])
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(path)
    common.discard(df)
    assert not files.exists(path)


def test_runs_stay_whole_over_batches_and_all_their_pairs_are_seen():
    rng = np.random.default_rng(8)
    t, size = jaccard_join.Threshold(80), 40
    rows, want, lengths = [], set(), [1, 2, 3, 70, 5, 1, 130, 64, 65, 2]
    for key, length in enumerate(lengths):
        base = np.unique(rng.integers(1, 1 << 63, size, dtype=np.uint64))
        for i in range(length):
            s = base if i % 2 else np.unique(rng.integers(1, 1 << 63, size, dtype=np.uint64))
            rows.append({"key": key, "node": b"%02d-%04d" % (key, i), "n": len(s), "pos": 0, "root": b"%02d-%04d" % (key, i // 3),
                         "block": 0, "lo": 0, "hi": 0, "sketch": jaccard_join._sketch(s)})
        want |= {(b"%02d-%04d" % (key, i), b"%02d-%04d" % (key, j)) for i in range(1, length, 2)
                 for j in range(i + 2, length, 2) if i // 3 != j // 3}
    batch = pa.RecordBatch.from_pylist(rows)
    for step in (1, 7, 100, len(rows)):
        parts = [batch.slice(lo, step) for lo in range(0, len(rows), step)]
        got = {(x, y) for b in jaccard_join._unconnected(t, 0, 16)(iter(parts)) for x, y in zip(*(c.to_pylist() for c in b.columns))}
        assert got == want
