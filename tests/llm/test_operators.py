"""The corpus operators against brute force on small fixtures: NULLs, empty and
long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from quietude.llm import (bpe, exact_dedup, html_extract, jaccard_join, language_id, mixing, quality, queries, repeats,
                          topk, url_filter)
from quietude.llm.linear import fit_hinge
from quietude.llm.topk import KDTree

DOC = "doc_id long, text string, lang string, source string, kept boolean, size long, id string, row string, root string"
rng = np.random.default_rng(5)
WORDS = ["".join(rng.choice(list("abcdefgé"), rng.integers(2, 7))) for _ in range(300)]


def words(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


LONG = words(6000, 1)
TEXTS = [None, "", " \t\n", "one", "One", "one two", "ÀB one", "àB one", words(60, 2), words(60, 2).upper(), words(60, 2),
         LONG, LONG[:20000] + " zz " + LONG[20000:], "x" * 700, "xy" * 300, words(90, 3) + " tail", words(90, 3) + " other",
         words(12, 4), words(12, 4) + " q", "shared " + words(80, 6), words(80, 6) + " shared", None, "1234 5678 !!"]


def frame(spark, texts=TEXTS):
    rows = [(i, t, "en" if i % 2 else None, [None, "a", "b"][i % 3], True, i, "i", "r", "o") for i, t in enumerate(texts)]
    rows += [(None, "one", None, None, None, None, None, None, None), rows[8], rows[8]] if texts else []
    return spark.createDataFrame(rows, DOC)


def low(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def test_exact_dedup(spark):
    docs = frame(spark)
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(low(r.text), []).append(-1 if r.doc_id is None else r.doc_id)
    want = Counter()
    for r in rows:
        own = groups[low(r.text)]
        want[(r.doc_id, max(own) if max(own) >= 0 else None, len(own), hashlib.sha256(low(r.text).encode()).hexdigest())] += 1
    got = exact_dedup.label_copies(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(low(r.text) for r in kept.collect()) == sorted(groups)
    tight = exact_dedup.label_copies(docs, max_bits=1)  # a full filter changes nothing
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in tight.collect()) == want
    assert exact_dedup.label_copies(frame(spark, [])).count() == exact_dedup.drop_copies(frame(spark, [])).count() == 0


def brute_links(rows, percent, n):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets[i] = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("percent,n", [(90, 3), (80, 5)])
def test_jaccard_join(spark, percent, n):
    base = words(40, 9).split()
    texts = [*TEXTS[:17], *[" ".join(base[:k]) for k in range(8, 41)], *[" ".join([*base[:k], "new", *base[k:]]) for k in (3, 20, 39)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS node", "3 AS key")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(docs, percent=percent, words=n).collect()}
    want = brute_links(list(enumerate(texts)), percent, n)
    assert got == want
    kept = jaccard_join.keep_one(docs, percent=percent, words=n)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (k, r) in want.items() if k == 0 or r == i)


def test_jaccard_repeated_null_and_empty(spark):
    docs = frame(spark)
    got = jaccard_join.link(docs).collect()
    assert len(got) == docs.count()
    assert {r.component_id for r in got if r.n_shingles == 1 and r.doc_id in (3, 4, None)} == {3}
    assert jaccard_join.link(frame(spark, [])).count() == jaccard_join.keep_one(frame(spark, [])).count() == 0


def test_boundary_follows_cost():
    t = jaccard_join.Threshold(90)
    assert jaccard_join.choose_boundary({15: 1000}, 0.0, t) == 0
    assert jaccard_join.choose_boundary({15: 1000}, 500.0, t) >= 15
    for a in range(1, 60):
        for b in range(a, 70):
            need = next(i for i in range(a + b + 1) if 100 * i >= 90 * (a + b - i))
            assert t.overlap(a, b) == need


def brute_repeats(texts, length):
    seen = Counter(b[p:p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        out.append((len(b), int(gone.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_repeats(spark):
    docs = frame(spark, [t if t is None or len(t) < 9000 else t[:9000] for t in TEXTS])
    rows = [(r.text or "").encode() for r in docs.select("text").collect()]
    got = repeats.repeats(docs).collect()
    assert Counter((r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), r.kept_sha256) for r in got) == Counter(brute_repeats(rows, 200))
    assert all(a["end"] < b["start"] for r in got for a, b in zip(r.spans, r.spans[1:]))
    assert repeats.repeats(frame(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.text("ab", min_size=1, max_size=12), st.text("ab", max_size=6)), min_size=1, max_size=14))
def test_backward_extension(rows):
    rows = sorted((b, r.encode(), x.encode()) for b, r, x in rows)
    least, greatest = repeats.repeated_offsets(np.array([r[0] for r in rows]), [r[1] for r in rows], [r[2] for r in rows], 12)
    for i, (b, r, x) in enumerate(rows):
        hits = [d for d in range(len(x) + 1) if len(r) >= 12 - d and any(
            j != i and b == c and s[:12 - d] == r[:12 - d] and len(s) >= 12 - d and len(y) >= d and y[:d] == x[:d]
            for j, (c, s, y) in enumerate(rows))]
        assert (greatest[i] < 0) if not hits else (least[i], greatest[i]) == (min(hits), max(hits))


def test_mixing(spark):
    docs = frame(spark, [*TEXTS, *[words(50, s) for s in range(40)]])
    got = mixing.mix_sizes(docs, (3, 1, 2), block_words=16).collect()
    assert len(got) == docs.count()
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(re.findall(mixing.WORD, r.text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, mixing.targets([size[s] for s in order], [3, 1, 2], 1.5, 2.0)))
    assert math.isclose(sum(want.values()), 1.5 * sum(size.values()))
    by_target = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        by_target[r.target] += r.taken
    for target, taken in by_target.items():
        assert target in want.values() and abs(taken - target) <= 40
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_sizes(docs, (3, 1, 2), block_words=16).collect()), key=str)
    mixed = mixing.mixed_documents(docs, (3, 1, 2), block_words=16)
    assert mixed.columns == docs.columns
    assert sum(len(re.findall(mixing.WORD, r.text)) for r in mixed.collect()) == sum(by_target.values())
    assert mixing.mix_sizes(frame(spark, []), (1,)).count() == mixing.mixed_documents(frame(spark, []), (1,)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 99))
def test_permutation(n, key):
    assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))


def test_shards_add_up():
    plan = mixing.Plan(16, (40, 7, 90), (60, 14, 33), 10, 3)
    rows = [mixing.shard_slots(plan, s) for s in range(plan.shards)]
    taken = Counter((s, b) for r in rows for s, b in zip(r["src"], r["block"]))
    assert max(taken.values()) <= 2 and Counter(s for r in rows for s in r["src"]) == {0: 60, 1: 14, 2: 33}


def test_topk(spark):
    vectors = np.round(np.random.default_rng(1).normal(size=(300, 6)), 1)
    rows = [(i * 10, v.tolist(), "x", 1) for i, v in enumerate(vectors)] + [(7, vectors[0].tolist(), "x", 1)] * 3
    rows += [(50_000, None, "x", 1), (60_000, [1.0, None] * 3, "x", 1), (70_000, [float("nan")] * 6, "x", 1), (None, vectors[1].tolist(), "x", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, shard int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, "id % 100 = 0", k=5, shard_rows=64, block_rows=8, leaf_rows=8).collect()}
    ints = [(i, np.floor(1024 * np.array(v)).astype(np.int64)) for i, v, _, _ in rows if i is not None and i < 50_000]
    want = {}
    for q, v in ints:
        if q % 100 == 0:
            best = sorted(((-int(v @ w), i) for i, w in ints if i != q))[:5]
            want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best)}
    assert got == want
    assert topk.top_k(df.where("vec_id < 0"), "id = 0").count() == 0


def test_kd_tree_handles_equal_vectors():
    ids, v = np.arange(1000)[::-1].copy(), np.ones((1000, 3))
    best = []
    KDTree(ids, v, 16).search(np.ones(3), 0, 4, best)
    assert sorted(-i for _, i in best) == [1, 2, 3, 4]


@pytest.mark.parametrize("url,rule,verdict", [
    ("http://a.example.org/es/x", "example.org/es/", "block"), ("HTTP://EXAMPLE.ORG/en/17?x", "example.org/en/1", "block"),
    ("http://example.org/en/2", "org/", "allow"), ("http://notexample.org/es/", "org/", "allow"), ("http://org?x", None, "allow"),
    ("https://x.com/de/#f", "com/de/", "block"), ("https://x.com/dex", None, "allow"), (None, None, "allow"), ("no url", None, "allow")])
def test_url_filter(spark, url, rule, verdict):
    host, path = url_filter.split_url(url)
    found = url_filter.match(url_filter.build_trie(url_filter.RULES), host, path) if host or path else None
    assert (found[0] if found else None, found[1] if found else "allow") == (rule, verdict)


def test_url_filter_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "r"), (None, None, "r"), (1, "http://a.org/", "r")], "page_id long, url string, rule string")
    assert [tuple(r) for r in url_filter.judge_urls(pages, url_filter.RULES).collect()] == [
        (1, "a.org", "/", "org/", "allow"), (None, "", "", None, "allow"), (1, "a.org", "/", "org/", "allow")]
    assert url_filter.judge_urls(pages.limit(0), url_filter.RULES).count() == 0


PAGE = ("<html><head><title>t</title></head><body><header>Site</header><nav><a href=/>Home</a></nav><div class='{c}'><h1>T{n}</h1>"
        "<p>Text&nbsp;{n}\n &amp;lt; <b>bold</b><br>line<p>Second {n}</div><div>All rights</div><div class='user-comments'><p>me too</p></div>"
        "<div id=cookieNotice>ok?</div><form>f</form><aside>s</aside><script>var x='</p>';</script><footer>F{n}</footer></body></html>")


def test_html_extract(spark):
    want = "T{0}\nText {0} &lt; bold line\nSecond {0}"
    for c in ("post", "entry"):
        got = html_extract.extract_group([PAGE.format(n=n, c=c) for n in range(5)])
        assert got == [want.format(n) for n in range(5)]
    rows = [(n, "http://h.example/", PAGE.format(n=n, c="p"), "x") for n in range(4)] + [(9, None, None, "x"), (None, "", "", "x")]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, text string")
    got = html_extract.extract(pages).collect()
    assert Counter(r.text for r in got) == Counter([*[want.format(n) for n in range(4)], want.format(0), "", ""])
    assert html_extract.extract(pages.limit(0)).count() == 0
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert html_extract.extract_group([deep, deep + " ", deep + "y", "<p>a <1 & b"]) [0] == "x"


def test_html_alignment_decides_inside_articles():
    page = "<body><article><h1>T{0}</h1><p>Text {0}</p><p>Read more of our stories</p></article><div><p>Outside {0}</p></div></body>"
    got = html_extract.extract_group([page.format(n) for n in range(4)])
    assert got == [f"T{n}\nText {n}\nOutside {n}" for n in range(4)]
    # Copies of an article are one witness: their text isn't template, on their own or beside other pages.
    body = "".join(f"<p>{words(40, n)}</p>" for n in range(5))
    copies = [f"<body><article>{body}</article><div>Seen {n}</div></body>" for n in range(5)]
    assert all(words(40, 0) in t and words(40, 4) in t for t in html_extract.extract_group(copies))
    assert html_extract.extract_group([f"<head><title>{n}</title></head><article><p>same</p></article>" for n in range(4)]) == ["same"] * 4


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'><article><p>{}</p></article></div>", "<div class=sidebar><article><p>{}</p></article></div>",
    "<div id='search-results-page'><p>{}</p></div>", "<form id=aspnetForm><div><p>{}</p></div></form>", "<div class=search><main>{}</main></div>",
    "<form><article><p>{}</p><div class=comment-body>me too</div></article></form>", "<div class=notice>{}</div>",
    "<article><section id='social-history'><p>{}</p></section></article><div class=related-posts><article>other</article></div>",
    "<div class=ad>Buy this, it is longer than the text.</div><p>{}</p><div class='comments'><p>I think that is a good one</p></div>"])
def test_html_names_lose_no_content(page):
    got = html_extract.extract_group([f"<body><nav>menu</nav>{page.format('The text')}<div class='site-footer'>F</div></body>"])
    assert got == ["The text"]


def test_html_template_outvotes_odd_pages(spark):
    page = "<body><div><p>Home of news</p><p>{1}</p></div><div><h1>T{0}</h1><p>Text {0}</p></div><div>All rights</div></body>"
    normal = [page.format(n, "Menu") for n in range(12)]
    want = [f"T{n}\nText {n}" for n in range(12)]
    error = "<body><table><tr><td>Not found</table></body>"
    assert html_extract.extract_group([error, *normal])[1:] == want  # an odd page first
    assert html_extract.extract_group([page.format(12, "Other"), *normal])[1:] == want  # one that differs at a slot
    shifted = normal[0].replace("<div><p>Home", "<div>New<p>Home").replace("<div>All", "<div>Today<br><p>x</p>All")
    assert html_extract.extract_group([shifted, *normal[1:]])[1:] == want[1:]  # one with another block before
    # Long pages and any number of partitions: a page's group is the same.
    filler = "<script>" + "x" * (3 << 20) + "</script>"
    long = [(n, "http://big.example/", h + filler) for n, h in enumerate(normal)]
    rows = long + [(n, f"http://h{n % 3}.example/{n}", page.format(n, "Menu")) for n in range(100, 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        deals = set()
        for width in ("1", "3", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            deals.add(frozenset((r.id, r.host, r.deal) for r in html_extract.groups(pages).select("id", "host", "deal").collect()))
            got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
            assert got == {r[0]: f"T{r[0]}\nText {r[0]}" for r in rows}
        assert len(deals) == 1 and len({(h, d) for _, h, d in next(iter(deals))}) >= 7
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_tree_matching_is_largest():
    page = lambda s: html_extract.Page(s).root
    a, b = page("<div><p>1<p>2</div><ul><li>x</ul>"), page("<ul><li>y<li>z</ul><div><p>3</div><ul><li>q</ul>")
    assert html_extract.match(a, b) == 1 + 2 + 2


VOCAB = bpe.vocabulary(public_tokenizers.path(queries.BYTE_BPE))
LIBRARY = Tokenizer.from_file(public_tokenizers.path(queries.BYTE_BPE))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("ab 'st\n\t é中1.", max_size=60), st.just("a<|endoftext|>b")), max_size=5))
def test_bpe_equals_library(texts):
    ids, counts = VOCAB.encode(texts)
    ends = np.cumsum(counts).tolist()
    for t, lo, hi, decoded in zip(texts, [0, *ends], ends, VOCAB.decode(ids, counts)):
        want = LIBRARY.encode(t, add_special_tokens=False).ids
        assert ids[lo:hi].tolist() == want and decoded == LIBRARY.decode(want, skip_special_tokens=False) == t


def test_bpe_frames(spark):
    docs, path = frame(spark, TEXTS[:20] + ["z" * 4000]), public_tokenizers.path(queries.BYTE_BPE)
    coded = bpe.encode(docs, path, keep=("source",))
    assert coded.columns == ["doc_id", "source", "ids"]
    decoded = Counter((r.doc_id, r.text) for r in bpe.decode(coded, path).collect())
    assert decoded == Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert bpe.round_trip(docs.limit(0), path).count() == 0


def test_language_and_quality_on_held_out_rows(spark):
    from tests.conftest import SF_ORACLE
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    got = [r for r in queries.op3_language_id(spark, SF_ORACLE).collect() if r.held_out]
    assert got and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in got) >= 0.97 * len(got)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    found = {r.doc_id: r for r in queries.op5_quality(spark, SF_ORACLE).collect()}
    assert len(found) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    held = [r for r in found.values() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.9 * len(held)


def test_language_edge_cases(spark):
    docs = frame(spark)
    from pyspark.sql import functions as F
    model = language_id.fit(docs, F.lit(True))
    got = language_id.predict(docs, model).collect()
    assert len(got) == docs.count()
    assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2, 22)} == {"und"}
    assert {r.lang_pred for r in got if r.doc_id in (3, 11)} == {"en"}
    assert language_id.keep_known(docs, model).columns == docs.columns
    none = language_id.fit(docs, F.lit(False))
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(3, 1), (3, 0), (8, None), (99, 1), (None, 1)], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, labels, F.lit(True)))
    assert scored.count() == docs.count()
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0), F.lit(True))).collect()} == {0.5}


def test_hinge_separates():
    rows = [(np.array([i % 2]), np.array([1.0])) for i in range(20)]
    w, b = fit_hinge(rows, np.array([1.0 if i % 2 else -1.0 for i in range(20)]), 2, cost=10.0)
    assert w[1] + b > 0.5 and w[0] + b < -0.5


def test_jaccard_join_takes_sets_of_any_size(spark):
    long = " ".join(map(str, range((1 << 21) + 10)))
    docs = spark.createDataFrame([(0, long), (1, long + " end"), (2, words(60, 2)), (3, words(60, 2) + " end"), (4, words(60, 3))],
                                 "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(docs, percent=90, words=1).collect()}
    assert got[0] == ((1 << 21) + 10, 0) and got[1] == ((1 << 21) + 11, 0)
    assert got[2][1] == got[3][1] == 2 and got[4][1] == 4


def test_pipeline_rejects_unlearned_languages(spark):
    from pyspark.sql import functions as F
    from tests.conftest import SF_ORACLE
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").where("text IS NOT NULL")
    few = docs.limit(1)
    letters = np.random.default_rng(3)
    bad = ["".join(letters.choice(list("abcdefghijklmnopqrstuvwxyz     "), 400)),
           "Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił.",
           "Шла Саша по шоссе и сосала сушку, а потом пошла домой и легла спать до самого утра."]
    model = language_id.fit(docs.where("lang != 'es'"), F.lit(True))
    for text in bad:
        assert language_id.keep_known(few.withColumn("text", F.lit(text)), model).count() == 0
    # A language that the model has not learned goes; texts of the learned ones stay.
    kept = {r.lang: r["count"] for r in language_id.keep_known(docs, model).groupBy("lang").count().collect()}
    total = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    assert kept.get("es", 0) <= 0.1 * total["es"]
    assert all(kept[lang] >= 0.99 * total[lang] for lang in total if lang != "es")
    rows = spark.createDataFrame([(10 ** 6 + i, t, None, None, len(t)) for i, t in enumerate(bad)], docs.schema)
    out = corpus_pipeline.identify_language(spark, docs.unionByName(rows), "")
    assert out.where(f"doc_id >= {10 ** 6}").count() == 0 and out.count() >= 0.99 * docs.count()


def test_pipeline_stages(spark):
    docs = frame(spark, [*TEXTS, *[words(40, s) for s in range(30)]]).selectExpr("doc_id", "text", "'en' AS lang", "source", "length(text) AS n_chars")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, out = out, stage(spark, out, "")
        assert out.columns == docs.columns, name
        if name == "exact_dedup":
            assert sorted(low(r.text) for r in out.collect()) == sorted({low(r.text) for r in before.collect()})
        if name == "near_dedup":
            left = brute_links([(i, r.text) for i, r in enumerate(out.collect())], 80, 5)
            assert all(root == i for i, (_, root) in left.items())
    last = corpus_pipeline.STAGES[-1][1](spark, out, "").collect()
    assert sum(r.n_tokens for r in last) == sum(len(LIBRARY.encode(r.text, add_special_tokens=False).ids) for r in out.collect())
