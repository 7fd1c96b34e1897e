"""Collocations, Merkle manifest and license scan against brute force and their SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quietude.llm import collocation, license_scan, merkle, queries
from quietude.llm.license_rules import RULES, WINDOW, Rule

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_collocations", "op12_merkle", "op13_license"])
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    found = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in found.description]
    assert columns == df.columns
    assert rows_of(df) == sorted(found.fetchall(), key=repr)


# --- collocations -----------------------------------------------------------

def brute_collocations(docs, least, subsumed, top):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[(lang, *words[i:i + k])] += 1
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for (lang, *words), a in cands.items():
        if len(words) == 2 and any(p[0] == lang and len(p) == 4 and words in (list(p[1:3]), list(p[2:4])) and 100 * b >= subsumed * a
                                   for p, b in cands.items()):
            continue
        cuts = [(f[(lang, *words[:k])], f[(lang, *words[k:])]) for k in range(1, len(words))]
        score, _, left, right = min((1000000 * a * a // (x * y), i, x, y) for i, (x, y) in enumerate(cuts))
        out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    result, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            result.append((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return result


def test_collocations_brute_force(spark):
    rnd = random.Random(5)
    words = ["a", "b", "C", "ü", "Ü", "dd", "e e", "f\x1cf", "-"]
    texts = ["".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t", ", ", ".", "\n", " ; "]) for _ in range(rnd.choice([0, 1, 30, 200])))
             for _ in range(40)]
    docs = [(t, rnd.choice(["x", "y", None])) for t in texts] + [(None, "x"), ("", None), ("...", "z"), (" ".join(["a b"] * 3000), "x")]
    docs += docs[:4]
    df = spark.createDataFrame([(t, lang, 1, "p") for t, lang in docs], "text string, lang string, rank int, phrase string").repartition(5)
    for least, top in ((1, 10 ** 6), (4, 20)):
        found = collocation.collocations(df, least=least, subsumed=50, top=top)
        assert rows_of(found) == sorted(brute_collocations(docs, least, 50, top), key=repr)


def test_collocations_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocation.collocations(empty).count() == 0
    assert collocation.collocations(spark.createDataFrame([(1, None, None, None, None), (2, " .\t", "x", None, 1)], SCHEMA)).count() == 0


def test_stripes_across_flushes_and_slices(monkeypatch):
    """Small slices and buffers, hot prefixes cut in parts: the same counts."""
    rnd = random.Random(2)
    texts = [("x", " ".join(rnd.choice(["a", "b", "c", "longword" * 3, "d."]) for _ in range(n)).encode()) for n in (0, 1, 2, 3, 500, 70)]
    monkeypatch.setattr(collocation, "SLICE", 7)
    monkeypatch.setattr(collocation, "FLUSH", 11)
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in texts]), pa.array([t for _, t in texts], pa.binary())], ["lang", "text"])
    everything = __import__("numpy").full(4096, 255, "uint8")
    for size in (0, 1, 2):
        expected = Counter()
        for _, t in texts:
            for piece in t.decode().split("."):
                w = piece.split()
                expected.update((" ".join(w[i:i + size]), w[i + size]) for i in range(len(w) - size))
        found, parts = Counter(), set()
        for out in collocation._counted(size, everything, {"x": {b"a": 3, b"a b": 2}})(iter([batch])):
            for lang, prefix, part, words, counts, most in zip(*(c.to_pylist() for c in out.columns)):
                parts.add((prefix, part))
                assert most == max(map(int, counts.split(b" ")))
                for w, n in zip(words.split(b" "), counts.split(b" ")):
                    found[(prefix.decode(), w.decode())] += int(n)
                    if size:
                        assert part == zlib.crc32(w) % {b"a": 3, b"a b": 2}.get(prefix, 1)
        assert found == expected
        assert size != 1 or len([p for p in parts if p[0] == b"a"]) > 1


# --- Merkle manifest --------------------------------------------------------

def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    def levels(hashes):
        out = [hashes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    def siblings(tree, i):
        path = []
        for level in tree[:-1]:
            a = i - i % 3
            path.append((level[a:i], level[i + 1:a + 3]))
            i //= 3
        return path

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    trees = [levels([leaf(r) for r in g]) for g in groups]
    top = levels([t[-1][0] for t in trees])
    out = []
    for s, (group, tree) in enumerate(zip(groups, trees)):
        for i, r in enumerate(group):
            path = siblings(tree, i) + siblings(top, s)
            changed = r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                changed = (*r[:4], r[4].replace("\n", ""))
            h = leaf(changed)
            for a, b in path:
                h = sha("".join([*a, h, *b]))
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in path)), h, h == top[-1][0]))
    return out


def op12(df):
    return merkle.verify(df, altered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, where=merkle.even_crc(F.col("doc_id")))


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2, 3, 4], [100, 1, 9, 27], [250, 10], [1] * 85])
def test_merkle_brute_force(spark, sizes):
    rnd = random.Random(len(sizes))
    names = [None, "", "é", "Z", "a b"] + [f"s{i}" for i in range(90)]
    ids = list(range(sum(sizes)))
    rnd.shuffle(ids)
    rows = [(ids.pop() - 5, names[s], rnd.choice(["en", None, ""]), rnd.choice([1, None]), rnd.choice(["x\ny", "\n", "", None, "ü"]))
            for s, size in enumerate(sizes) for _ in range(size)]
    df = spark.createDataFrame([(*r, 7, "q") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, "
                               "leaf int, grp string").repartition(4)
    assert rows_of(op12(df)) == sorted(brute_manifest(rows), key=repr)


def test_merkle_repeated_and_null_ids(spark):
    rows = [(None, "s", "en", 1, "a\nb")] * 40 + [(3, "s", None, 2, "t")] * 30 + [(3, "s", "en", 2, "u")] * 3 + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert rows_of(op12(df)) == sorted(brute_manifest(rows), key=repr)
    assert op12(df.where("doc_id = 5")).count() == 0


def test_merkle_any_change_shows(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    found = merkle.verify(df, altered={"n_chars": F.lit(2)}, where=F.col("doc_id") == 7).collect()
    assert [r["doc_id"] for r in found if not r["verified"]] == [7]


# --- license scan -----------------------------------------------------------

def brute_scan(text, rules):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low) if w]
    found = []
    for i in range(len(words)):
        rest = " ".join(words[i:i + WINDOW])
        for k, r in enumerate(rules):
            m = re.match(f"(?:{r.pattern})(?: |$)", rest)
            if m:
                found.append((i, i + len(m.group().split()), k, r))

    def beats(e, d):
        if e[:2] == d[:2]:
            return e[3].priority > d[3].priority or (e[3].priority == d[3].priority and e[2] < d[2])
        return e[0] <= d[0] and e[1] >= d[1] and e[3].priority >= d[3].priority

    kept = [d for d in found if not any(beats(e, d) for e in found)]
    base = [d for d in found if d[3].base]
    return (len(words), len(base), min((d[0] for d in base), default=None), max((d[0] for d in base), default=None),
            ",".join(sorted({d[3].label for d in base})), ",".join(sorted({d[3].label for d in base + kept})),
            max((license_scan.WEIGHTS[d[3].priority] for d in kept), default=0.0))


TEXTS = [None, "", "...", "Released under the MIT License.", "mit license MIT-License, mit  LICENSE", "CC-BY-SA 4.0 and CC BY; cc/by",
         "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
         "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
         "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
         "SPDX-License-Identifier: GPL-2.0-or-later", "gnu lesser general public license version 2.1 or later", "mit licensex, xmit license",
         "Lizenz mit licenseé mit license  gnu gnu general public license", "BSD 3-Clause License; bsd license. All rights reserved.",
         "neither the name of the copyright holder nor the names of its contributors may be used to endorse",
         " ".join(["apache license mit license cc by"] * 3000), "x" * 200_000 + " mit license"]


def test_license_scan_brute_force(spark):
    df = spark.createDataFrame([(i, t, "l", 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "l", 1)],
                               "doc_id long, text string, labels string, words int").repartition(3)
    found = {r[0]: tuple(r)[1:] for r in license_scan.scan(df).collect()}
    assert license_scan.scan(df).count() == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        if t and len(t) > 50_000 and "apache" in t:
            assert found[i][:4] == (18000, 9000, 0, 17998)
        else:
            assert found[i] == brute_scan(t, RULES), t
    assert found[8][5] == "gpl-2.0" and found[8][6] == 1.0
    assert found[6][5] == "apache,apache-2.0"
    assert license_scan.scan(df.limit(0)).count() == 0


def test_license_rules_are_sound():
    """Hundreds of rules, each gated by a word, none of them longer than the window."""
    assert len(RULES) > 300 and len({r.pattern for r in RULES}) == len(RULES)
    parser = re._parser

    def blanks(node):
        if not isinstance(node, tuple):
            return sum(blanks(x) for x in node)
        kind, value = str(node[0]), node[1]
        if kind == "LITERAL":
            return int(value == 32)
        if kind == "BRANCH":
            return max(blanks(x) for x in value[1])
        if kind == "SUBPATTERN":
            return blanks(value[3])
        if kind == "MAX_REPEAT":
            inner = blanks(value[2])
            assert not inner or value[1] < WINDOW
            return inner and value[1] * inner
        return 0

    for r in RULES:
        assert blanks(parser.parse(r.pattern)) < WINDOW, r
        assert "\\" not in r.pattern and r.pattern == r.pattern.lower()


def test_license_suppression_by_priority(spark):
    rules = [Rule("short", 2, "a b"), Rule("long", 1, "a b c"), Rule("same", 2, "a b"), Rule("wide", 2, "x a b c d"), Rule("base", 0, "b c", True)]
    df = spark.createDataFrame([(1, "a b c"), (2, "x a b c d"), (3, "a b a b c")], "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in license_scan.scan(df, rules).collect()}
    assert found == {i: brute_scan(t, rules)[5] for i, t in ((1, "a b c"), (2, "x a b c d"), (3, "a b a b c"))}
    assert found[2] == "base,wide" and found[1] == "base,long,short"


def test_native_plan_has_no_python(spark):
    plan = license_scan.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
