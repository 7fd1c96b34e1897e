"""Registered queries of the text-corpus operators, one per operator, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietude.llm import (bpe, collocation, exact_dedup, html_extract, jaccard_join, language_id, license_scan, merkle, mixing,
                          quality, repeats, topk, url_filter)
from quietude.llm.common import LOWER, UPPER, table


#: Vocabulary of the registered query: a file of the Python environment, which
#: every executor has.
BYTE_BPE = "byte_bpe_50k.json"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.label_copies(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.fold(F.col("doc_id"), 4, missing=2) == 2
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language_id.fold(F.col("doc_id"), 5, missing=0) == 0
    model = quality.fit(docs, labels, ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.RULES)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (html_extract.extract(table(spark, sf_dir, "pages"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2.0)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"), percent=90, words=3)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.verify(docs, altered={"text": F.replace("text", F.lit("\n"), F.lit(""))},
                         where=merkle.even_crc(F.col("doc_id")))


def op13_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe, op2_exact_dedup, op3_language_id, op4_topk, op5_quality, op6_url_filter, op7_suffix_dedup, op8_html_extract, op9_mixing,
        op10_jaccard_join, op11_collocations, op12_merkle, op13_license)}

_RULE_ROWS = ", ".join(
    f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{a}')" for a, r in url_filter.RULES)

ORACLE: dict[str, str] = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS s FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY s) AS keep_id,
               count(*) OVER (PARTITION BY s) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
        FROM d""",
    "op4_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(
                          CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id != c.vec_id WHERE q.vec_id % 100 = 0),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op6_url_filter": rf"""
        WITH r(rule, rhost, rpath, action) AS (VALUES {_RULE_ROWS}),
             a AS (SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
                          THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
             u AS (SELECT page_id,
                          translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
             m AS (SELECT page_id, rule, action, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost) DESC, length(rpath) DESC) AS n
                   FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
        SELECT u.page_id, host, path, m.rule, coalesce(m.action, 'allow') AS verdict
        FROM u LEFT JOIN m ON u.page_id = m.page_id AND m.n = 1""",
    "op11_collocations": collocation.oracle(),
    "op12_merkle": """
        WITH RECURSIVE d AS (
            SELECT doc_id, source, text,
                   concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END,
                          CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
                          CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
                          CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END) AS head,
                   xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                       lambda crc, byte: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(crc, byte)),
                       CAST(4294967295 AS BIGINT))) % 2 = 0 AS altered
            FROM documents),
        leaf AS (
            SELECT doc_id, source,
                   sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS h,
                   CASE WHEN altered AND text IS NOT NULL
                        THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
                        ELSE sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) END AS other
            FROM d),
        place AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
                   count(*) OVER (PARTITION BY source) AS n,
                   dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM leaf),
        tree(place, lvl, pos, n, h) AS (
            SELECT place, 0, pos, n, h FROM place
            UNION ALL
            SELECT place, lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM tree
            WHERE n > 1 GROUP BY place, lvl, pos // 3),
        sub AS (SELECT place, max(lvl) AS height, arg_max(h, lvl) AS subroot FROM tree GROUP BY place),
        top(lvl, pos, n, h) AS (
            SELECT 0, place, (SELECT count(*) FROM sub), subroot FROM sub
            UNION ALL
            SELECT lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM top
            WHERE n > 1 GROUP BY lvl, pos // 3),
        path AS (
            SELECT p.place, p.pos AS own, CAST(l.lvl AS INTEGER) AS lvl,
                   CASE WHEN l.lvl < s.height THEN p.pos // CAST(pow(3, l.lvl) AS BIGINT)
                        ELSE p.place // CAST(pow(3, l.lvl - s.height) AS BIGINT) END AS spot,
                   s.height
            FROM place p JOIN sub s ON p.place = s.place,
                 (SELECT unnest(range((SELECT max(height) FROM sub) + (SELECT max(lvl) FROM top))) AS lvl) l
            WHERE l.lvl < s.height + (SELECT max(lvl) FROM top)),
        sibling AS (
            SELECT path.place, own, path.lvl, string_agg(x.h, '' ORDER BY x.pos) FILTER (WHERE x.pos < spot) AS lefts,
                   string_agg(x.h, '' ORDER BY x.pos) FILTER (WHERE x.pos > spot) AS rights
            FROM path LEFT JOIN (
                SELECT place, lvl, pos, h, false AS upper FROM tree
                UNION ALL SELECT s.place, s.height + t.lvl, t.pos, t.h, true FROM sub s, top t) x
              ON x.place = path.place AND x.lvl = path.lvl AND x.upper = (path.lvl >= height) AND x.pos // 3 = spot // 3
            GROUP BY path.place, own, path.lvl),
        fold(place, own, lvl, h) AS (
            SELECT place, pos, 0, other FROM place
            UNION ALL
            SELECT f.place, f.own, f.lvl + 1, sha256(concat(s.lefts, f.h, s.rights))
            FROM fold f JOIN sibling s ON f.place = s.place AND f.own = s.own AND f.lvl = s.lvl),
        proof AS (SELECT place, own, sha256(string_agg(concat(lefts, rights), '' ORDER BY lvl)) AS p FROM sibling GROUP BY ALL),
        ended AS (SELECT place, own, arg_max(h, lvl) AS h FROM fold GROUP BY ALL),
        root AS (SELECT arg_max(h, lvl) AS root FROM top)
        SELECT p.doc_id, p.h AS leaf, s.subroot, root.root, coalesce(proof.p, sha256('')) AS proof_sha256,
               e.h AS folded_root, e.h = root.root AS verified
        FROM root, place p JOIN sub s ON p.place = s.place JOIN ended e ON e.place = p.place AND e.own = p.pos
             LEFT JOIN proof ON proof.place = p.place AND proof.own = p.pos""",
    "op13_license": license_scan.oracle(),
}
