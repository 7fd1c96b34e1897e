"""Passes over whole texts: which of them are worked on, shuffled and held together."""

import hashlib
import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quietude.llm import bpe, common, exact_dedup, jaccard_join, mixing, repeats
from quietude.session import ensure_checkpoint_dir


class Shared:
    def __init__(self, value):
        self.value = value


def _docs(spark, texts):
    return spark.createDataFrame([(i, "ab"[i % 2], t) for i, t in enumerate(texts)], "doc_id long, source string, text string")


def test_longs_in_filter_finds_all_keys_and_few_others(spark):
    keys = [5, -7, (1 << 62) + 3, -(1 << 63)]
    bitmap = common.key_filter(spark.createDataFrame([(k,) for k in keys], "k long"), len(keys))
    assert common.longs_in_filter(np.array(keys, np.int64), bitmap).all()
    assert common.longs_in_filter(np.arange(1000, 3000), bitmap).sum() < 10


def test_shingles_are_made_of_the_asked_texts_alone(spark, monkeypatch):
    texts, keys = ["a b c d", "e f g h", None, "i j k l"], np.array([11, 22, 33, 44], np.int64)
    wanted = common.key_filter(spark.createDataFrame([(22,)], "k long"), 4)
    seen = []
    whole = jaccard_join.shingle_sets

    def counted(data, offsets, words):
        seen.append(bytes(data))
        return whole(data, offsets, words)

    monkeypatch.setattr(jaccard_join, "shingle_sets", counted)
    batch = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(texts)], names=["text_key", "text"])
    out = [r for b in jaccard_join._wanted(3, Shared(wanted), False)(iter([batch])) for r in b.to_pylist()]
    assert seen == [b"e f g h"] and len(out) == 1
    assert jaccard_join._set_of(out[0]["content"], 3).tolist() == whole(np.frombuffer(b"e f g h", np.uint8), np.array([0, 7]), 3)[0].tolist()


def test_texts_of_a_class_that_differ_in_case_are_found_by_one(spark):
    """A class's texts need not be equal; each class must still get its text."""
    base = [f"w{i}" for i in range(40)]
    texts = [" ".join(base), " ".join(base).upper(), "  ".join(base), " ".join([*base[:-1], "x"]), "p q r", None, ""]
    got = {r.doc_id: r.component_id for r in jaccard_join.link(_docs(spark, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 5, 6: 6}


def test_posts_leave_in_small_batches(monkeypatch):
    texts = [" ".join(f"{d}w{i}" for i in range(100)) for d in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], names=["id", "text"])
    counts = Shared(np.ones(jaccard_join.CELLS, np.uint32))

    def posts():
        return list(jaccard_join._posted(5, jaccard_join.Threshold(80), 0, counts, 9.0)(iter([batch])))

    once = posts()
    monkeypatch.setattr(jaccard_join, "POSTS", 100)
    often = posts()
    assert len(once) == 1 and len(often) > 5 and max(b.num_rows for b in often) < 200
    assert pa.Table.from_batches(often).to_pylist() == once[0].to_pylist()


def test_shared_rows_do_not_depend_on_batches():
    rng, t = np.random.default_rng(4), jaccard_join.Threshold(80)
    names = [bytes([i]) * 16 for i in range(6)]
    rows = sorted((int(k), int(r), int(n), int(p), names[i]) for k, r, n, p, i in
                  zip(*(rng.integers(lo, hi, 400) for lo, hi in ((-40, 40), (0, 3), (10, 13), (-1, 3), (0, 6)))))
    expected = []  # as the docstring says it, row by row
    for key in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == key]
        others = [r for n, r in enumerate(own) if r[4] != own[0][4] and r != own[n - 1]]
        expected += [(key, r[4], *r[1:4], own[0][4]) for r in ([own[0], *others] if others else [])]

    def batches(size):
        for at in range(0, len(rows), size):
            key, rare, n, pos, node = zip(*rows[at:at + size])
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node, pa.binary()), pa.array(rare), pa.array(n), pa.array(pos)],
                                             names=["key", "node", "rare", "n", "pos"])
    for size in (1, 2, 3, 7, 400):
        out = [r for b in jaccard_join._shared(t, 0)(batches(size)) for r in zip(*(c.to_pylist() for c in b.columns))]
        assert [r[:6] for r in out] == expected
        assert not any(r[6] for r in out if r[1] == r[5])


def test_split_by_keys_passes_most_rows_by(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    keys = common.stored(spark.createDataFrame([(3,), (4999,), (7000,)], "k long"), "keys")
    doubtful, sure, _ = exact_dedup.split_by_keys(rows, "k", keys)
    doubtful, sure = ({r.k for r in x.collect()} for x in (doubtful, sure))
    assert {3, 4999} <= doubtful and len(doubtful) < 50 and doubtful | sure == set(range(5000)) and not doubtful & sure


def test_near_copies_go_and_all_other_rows_stay(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = _docs(spark, [base, base + " x", "a b c", None, "", base.upper(), "a b c d", base])
    docs = docs.unionByName(docs.where("doc_id IN (3, 6)")).withColumn("more", F.lit(1))
    kept = jaccard_join.keep_one(docs, percent=80, words=5)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 3, 4, 6]


def test_mixing_shuffles_whole_texts_once(spark, capsys):
    docs = _docs(spark, [" ".join(f"w{i}" for i in range(5 + n)) for n in range(40)])
    mixed = mixing.mixed_documents(docs, weights=(3, 1), share=1.5, cap=2.0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mixed.explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", capsys.readouterr().out)
    assert inputs and sum("text#" in i for i in inputs) == 1
    assert mixed.columns == docs.columns and mixed.count() > 0


def test_mixing_cuts_texts_without_python(spark, capsys):
    texts = ["  one\ttwo \n three\x0b", "a", " \u00a0\u2003x \U0001f600\r\nz\x1fq  é ", "w " * 9, "k\x00l m,\x0cn"]
    ranges = {0: [[(0, 3)], [(0, 1), (1, 3)], [(1, 2)], [(0, 1), (2, 3)], [(1, 3)]], 1: [[(0, 1)]],
              2: [[(0, 2)], [(1, 3)], [(0, 1), (1, 2), (3, 4)], [(0, 4)]], 3: [[(0, 2), (3, 5), (5, 6), (8, 9)]],
              4: [[(0, 2)], [(1, 3)], [(0, 1), (2, 3)]]}
    cases = [(n, texts[i], found) for n, (i, found) in enumerate((i, f) for i, each in ranges.items() for f in each)]

    def want(text, found):
        words = [m.span() for m in re.finditer(mixing.WORD, text)]
        joined = []
        for lo, hi in found:
            if joined and joined[-1][1] == lo:
                lo = joined.pop()[0]
            joined.append((lo, hi))
        return text if joined == [(0, len(words))] else " ".join(text[words[lo][0]:words[hi - 1][1]] for lo, hi in joined)

    rows = spark.createDataFrame(cases, "n long, text string, spans array<struct<lo:long,hi:long>>")
    tokens = F.regexp_extract_all("text", F.lit(mixing.WORD + mixing.BLANKS), F.lit(0))
    got = rows.withColumn("tokens", tokens).select("n", mixing.cut_words(F.col("text"), F.col("tokens"), F.col("spans")).alias("t"))
    assert {r.n: r.t for r in got.collect()} == {n: want(text, found) for n, text, found in cases}
    mixed = mixing.mixed_documents(_docs(spark, texts * 4), weights=(3, 1), block_words=2)
    mixed.explain()
    assert "EvalPython" not in capsys.readouterr().out


def test_repeats_stores_only_anchors_and_spans(spark, monkeypatch):
    names = []
    monkeypatch.setattr(repeats, "stored", lambda df, name, *more: names.append(name) or common.stored(df, name, *more))
    shared = "".join(f"s{i}," for i in range(80))
    rows = ["x" + shared + "y", shared, None, "x" + shared + "y", "short", "short"]
    got = {r.doc_id: r for r in repeats.repeats(_docs(spark, rows)).collect()}
    assert names == ["anchors", "spans"]
    digest = {n: hashlib.sha256(b).hexdigest() for n, b in ((0, b""), (1, b""), (2, b""), (3, b""), (4, b"short"), (5, b"short"))}
    assert {n: r.kept_sha256 for n, r in got.items()} == digest
    assert [len(got[n].spans) for n in range(6)] == [1, 1, 0, 1, 0, 0]


def test_word_cache_goes_with_its_task():
    vocab = bpe.Vocabulary(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    empty = dict(vocab.cache)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words here", None])], names=["id", "source"])
    out = bpe._worked(vocab, iter([batch, batch]), bpe._encoded, ["id", "ids"])
    first = next(out)
    assert len(vocab.cache) > len(empty)
    rest = list(out)
    assert vocab.cache == empty and vocab.cache_bytes == 0 and len(vocab.cache_ids) == len(empty)
    assert [b.to_pydict() for b in rest] == [first.to_pydict()] and first.column(1).to_pylist()[1] == []


def test_stored_bounds_batches_and_puts_the_setting_back(spark):
    before = spark.conf.get(common.ARROW_BYTES)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("t")).mapInArrow(sizes, "n long")
    assert max(r.n for r in common.stored(rows, "sizes", 1 << 20).collect()) < 2000
    assert max(r.n for r in common.stored(rows, "sizes").collect()) == 4000
    assert spark.conf.get(common.ARROW_BYTES) == before


def test_bpe_turns_few_rows_into_strings_at_a_time():
    texts = [f"t{i}" if i % 7 else None for i in range(1000)]
    parts = list(bpe._texts(pa.array(texts)))
    assert max(len(t) for _, t in parts) <= 256
    assert [(lo + n, t) for lo, part in parts for n, t in enumerate(part)] == [(i, t or "") for i, t in enumerate(texts)]


def test_repeats_creates_no_files_and_sees_replaced_input(spark, tmp_out):
    folder = ensure_checkpoint_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    shared = "".join(f"s{i}," for i in range(80))

    def removed(texts):
        pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": texts}), os.path.join(tmp_out, "documents.parquet"))
        docs = spark.read.parquet(os.path.join(tmp_out, "documents.parquet"))
        return {r.doc_id: [tuple(s) for s in r.spans] for r in repeats.repeats(docs).collect()}

    assert removed(["x" + shared + "y", shared]) == {0: [(1, 1 + len(shared))], 1: [(0, len(shared))]}
    assert removed(["x" + shared + "y", shared[::-1]]) == {0: [], 1: []}
    assert set(os.listdir(folder)) == before


def test_blocks_of_a_replaced_file_are_not_taken(spark, tmp_out):
    path = os.path.join(tmp_out, "rows.parquet")

    def total():
        return common.stored(spark.read.parquet(path).groupBy().sum("n").toDF("n"), "sum", None, True).first().n

    pq.write_table(pa.table({"n": [1, 2]}), path)
    assert total() == 3
    pq.write_table(pa.table({"n": [5, 6]}), path)
    assert total() == 11
