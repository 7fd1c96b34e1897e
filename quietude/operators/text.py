"""Text jobs: word count, keyword search and its count, sort records by name,
word frequency, keyword-category matches.

All work on whole texts: tokens come from ``split`` / ``regexp_extract_all``
over every line, counts are partial-aggregated before the shuffle, so a
very common word costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.functions.expr import E, q, round_half_up_sql, s
from quietude.operators.frequent import top_values

# --- fixed values that must equal the reference's -------------------------
# Whitespace characters that separate words (default Java tokenizer set).
WORD_SEPARATORS = r"[ \t\n\r\f]+"
DEFAULT_KEYWORD = "hadoop"
# Complaint keyword dictionary: category -> keywords (substring match).
COMPLAINT_KEYWORDS = {
    "traffic": ["traffic", "car", "vehicle", "honking", "horn", "road"],
    "construction": ["construction", "drilling", "building", "renovation", "hammer"],
    "industrial": ["factory", "industrial", "machinery", "equipment", "plant"],
    "entertainment": ["music", "party", "club", "bar", "nightclub", "concert"],
    "aircraft": ["aircraft", "airplane", "plane", "helicopter", "airport", "flight"],
    "neighbors": ["neighbor", "apartment", "upstairs", "next door", "loud talking"],
    "animals": ["dog", "barking", "pet", "animal", "rooster", "bird"],
    "public_events": ["event", "festival", "parade", "fireworks", "celebration"],
}
# Word runs (letters, digits, underscore in any script) and the kept form.
WORD_RUN = r"[\p{L}\p{N}_]+"
NON_WORD = r"[^\p{L}\p{N}_]+"
KEPT_WORD = r"^[a-z]{4,}$"
# ---------------------------------------------------------------------------


def word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """(word, count) over whitespace tokens (A1). Map-side combine is the
    partial HashAggregate."""
    words = F.explode(F.split(F.col(col), WORD_SEPARATORS)).alias("word")
    return (lines.select(words).filter(F.col("word") != "")
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def keyword_search(lines: DataFrame, keyword: str = DEFAULT_KEYWORD, col: str = "value") -> DataFrame:
    """Lines whose lower-case form contains ``keyword``, as ("Found", line)
    (P13). A filter only: no single-key shuffle."""
    return (lines.filter(F.lower(F.col(col)).contains(keyword.lower()))
            .select(F.lit("Found").alias("key"), F.col(col).alias("line")))


def keyword_count(lines: DataFrame, keyword: str = DEFAULT_KEYWORD, col: str = "value") -> DataFrame:
    """Number of matching lines (A2), one row."""
    return keyword_search(lines, keyword, col).agg(F.count(F.lit(1)).alias("match_count"))


def records_with_name(records: DataFrame, col: str = "value") -> DataFrame:
    """Records with at least three space-separated parts, keyed by the second
    (P14). Trailing separators do not make extra parts."""
    parts = F.split(F.regexp_replace(F.col(col), " +$", ""), " ")
    return (records.select(parts.alias("p"), F.col(col).alias("record"))
            .filter(F.size("p") >= 3)
            .select(F.col("p")[1].alias("name"), "record"))


def sort_by_name(records: DataFrame, col: str = "value") -> DataFrame:
    """(name, record) in name order (O1). Range-partitioned sort; the record is
    a secondary key so one very common name still splits across tasks."""
    return records_with_name(records, col).orderBy("name", "record")


def word_frequency(texts: DataFrame, col: str = "text", top: int | None = 20) -> DataFrame:
    """Words of four or more ASCII letters (whole word runs, lower-cased) and
    their counts, most frequent first, ties by word; ``top`` rows (A26).

    Word runs are the pieces between non-word characters; a run is kept only
    if it is entirely ``[a-z]`` (so accented words are not cut into ASCII
    fragments). The cheap length test runs before the pattern test.
    """
    out = (_kept_words(texts, col).groupBy("word").agg(E("count(1) AS count"))
           .orderBy(F.desc("count"), "word"))
    return out.limit(top) if top else out


def word_frequency_bounded(texts: DataFrame, col: str = "text", top: int = 20) -> DataFrame:
    """The rows of ``word_frequency`` with a bounded first shuffle: only words that
    may be among the first ``top`` are counted one by one. It reads the texts
    twice or more, so it is for corpora whose distinct words are the cost."""
    return top_values(_kept_words(texts, col), "word", top)


def _kept_words(texts: DataFrame, col: str) -> DataFrame:
    runs = texts.selectExpr(f"explode(split(lower({q(col)}), {s(NON_WORD)})) AS word")
    return runs.filter(f"length(word) >= 4 AND word RLIKE {s(KEPT_WORD)}")


def keyword_categories(texts: DataFrame, col: str = "text",
                       keywords: dict[str, list[str]] | None = None) -> DataFrame:
    """Texts matching any keyword of each category (substring, multi-label),
    with the share of all texts (A27). One scan with one conditional count
    per category instead of a text x keyword nested-loop join; each text is
    lower-cased once."""
    keywords = keywords or COMPLAINT_KEYWORDS
    low = texts.selectExpr(f"lower({q(col)}) AS _low")
    aggs = ["count(1) AS _total"]
    for i, kws in enumerate(keywords.values()):
        hit = " OR ".join(f"contains(_low, {s(kw)})" for kw in kws)
        aggs.append(f"count_if({hit}) AS _c{i}")
    wide = low.agg(*[E(a) for a in aggs])
    pairs = ", ".join(f"{s(cat)}, _c{i}" for i, cat in enumerate(keywords))
    return (wide.selectExpr("_total", f"stack({len(keywords)}, {pairs}) AS (category, match_count)")
            .selectExpr("category", "match_count",
                        f"{round_half_up_sql('100.0D * match_count / _total')} AS match_pct"))
