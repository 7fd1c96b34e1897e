"""License scan by ordered signature rules (DataFrame functions only).

A text's words are compared with the rules' keywords; only where a keyword
stands is a window of ``WINDOW`` words cut out, and only the rules of that
keyword are tried on it, each as one anchored regular expression. What matches
is a detection: a rule, the word it starts at and its number of words.

Detections overlap ("apache license version 2 0" holds "apache license"). One
is suppressed if another one's interval contains its own and has at least its
priority; of equal intervals the higher priority stays, then the rule that
comes first. A containing detection starts at most ``WINDOW`` words before, so
each is compared with the few around it and never with all of its document.

Everything about a document stays in its row: one scan, no shuffle, no group.
Steps hand over through a generator, so that no array is computed again for
each of its elements.

Defined cases: a NULL or wordless text has no words and no detection, score 0
and empty labels. Repeated rows are scanned each. Texts of any length are
scanned whole, in time proportional to their words. An empty table gives no
rows. Extra columns, also ones named like the result's, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.llm.common import ascii_lower, quoted
from quietude.llm.license_rules import RULES, WEIGHTS, WINDOW, Rule

#: What stands between words, once A-Z are lower-cased.
GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def _array(values) -> str:
    return "array(" + ", ".join(values) + ")"


def by_keyword(rules: list[Rule]) -> dict[str, list[int]]:
    """The numbers (from 1) of each keyword's rules."""
    out: dict[str, list[int]] = {}
    for i, r in enumerate(rules, 1):
        out.setdefault(r.keyword, []).append(i)
    return out


def _tried(rules: list[Rule]) -> str:
    """Detections at a hit ``h`` (word, at, text): the rules of its keyword."""
    whens = []
    for keyword, numbers in by_keyword(rules).items():
        found = _array(f"regexp_extract(h.text, {_text(f'^(?:{rules[i - 1].pattern})(?: |$)')}, 0)" for i in numbers)
        whens.append(f"WHEN {_text(keyword)} THEN zip_with({found}, {_array(map(str, numbers))}, (m, i) -> "
                     "named_struct('rule', i, 'n', IF(m = '', 0, size(split(rtrim(m), ' ')))))")
    return f"filter(CASE h.word {' '.join(whens)} END, d -> d.n > 0)"


def detections(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words and found, its detections in order of place as
    structs (at, n, rule, priority, label, base, kept); ``rule`` counts from 1."""
    norm = F.trim(F.regexp_replace(ascii_lower(quoted(text_col)), GAPS, " "))
    keywords = ", ".join(_text(k) for k in by_keyword(rules))
    priority = _array(str(r.priority) for r in rules)
    base = _array(str(r.base).lower() for r in rules)
    label = _array(_text(r.label) for r in rules)

    def step(df: DataFrame, expression: str, name: str, *keep: str) -> DataFrame:
        return df.selectExpr(*keep, f"explode(array({expression})) AS {name}")

    words = docs.select(quoted(id_col).alias("id"), norm.alias("norm"))
    words = step(words, "IF(norm = '', array(), split(norm, ' '))", "words", "id")
    places = ("filter(IF(size(words) = 0, array(), sequence(0, size(words) - 1)), "
              f"i -> element_at(words, i + 1) IN ({keywords}))")
    hits = step(words, f"transform({places}, i -> named_struct('at', i, 'word', element_at(words, i + 1), 'text', "
                f"array_join(slice(words, i + 1, {WINDOW}), ' ')))", "hits", "id", "CAST(size(words) AS BIGINT) AS n_words")
    tried = step(hits, f"filter(transform(hits, h -> named_struct('at', h.at, 'ds', {_tried(rules)})), h -> size(h.ds) > 0)",
                 "tried", "id", "n_words")
    # The hits that start fewer than WINDOW words before hit j are among the WINDOW hits that end with it.
    near = f"slice(tried, greatest(1, j - {WINDOW - 2}), least(j + 1, {WINDOW}))"
    holds = ("g.at <= h.at AND g.at + e.n >= h.at + d.n AND "
             f"CASE WHEN g.at = h.at AND e.n = d.n THEN element_at({priority}, e.rule) > element_at({priority}, d.rule) "
             f"OR (element_at({priority}, e.rule) = element_at({priority}, d.rule) AND e.rule < d.rule) "
             f"ELSE element_at({priority}, e.rule) >= element_at({priority}, d.rule) END")
    kept = f"NOT exists({near}, g -> exists(g.ds, e -> {holds}))"
    found = ("flatten(transform(tried, (h, j) -> transform(h.ds, d -> named_struct('at', CAST(h.at AS BIGINT), 'n', d.n, "
             f"'rule', d.rule, 'priority', element_at({priority}, d.rule), 'label', element_at({label}, d.rule), "
             f"'base', element_at({base}, d.rule), 'kept', {kept}))))")
    return step(tried, found, "found", "id", "n_words")


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels and score, the weight of the best detection kept.

    Base phrases are counted wherever they stand, suppressed or not."""
    weight = _array(f"{WEIGHTS[r.priority]}D" for r in rules)
    own = "filter(found, d -> d.base)"

    def labels(of: str) -> str:
        return f"array_join(array_sort(array_distinct(transform({of}, d -> d.label))), ',')"

    return detections(docs, rules, id_col, text_col).selectExpr(
        "id AS doc_id", "n_words", f"CAST(size({own}) AS BIGINT) AS n_base",
        f"array_min(transform({own}, d -> d.at)) AS first_word", f"array_max(transform({own}, d -> d.at)) AS last_word",
        f"{labels(own)} AS base_labels", f"{labels('filter(found, d -> d.base OR d.kept)')} AS labels",
        f"coalesce(array_max(transform(filter(found, d -> d.kept), d -> element_at({weight}, d.rule))), 0.0D) AS score")


def oracle(rules: list[Rule] = RULES) -> str:
    """DuckDB SQL for ``scan`` over ``documents``, by joins instead of arrays."""
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    rows = ", ".join(f"({i}, {text(r.label)}, {r.priority}, {text(r.keyword)}, {text(f'^(?:{r.pattern})(?: |$)')}, "
                     f"{str(r.base).lower()}, {WEIGHTS[r.priority]}::DOUBLE)" for i, r in enumerate(rules, 1))
    return rf"""
        WITH rule(rule, label, priority, keyword, pattern, base, weight) AS (VALUES {rows}),
        d AS (SELECT doc_id, row_number() OVER () AS row, list_filter(string_split(regexp_replace(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda w: w <> '') AS words FROM documents),
        h AS (SELECT row, spot, words[spot + 1] AS word, array_to_string(words[spot + 1:spot + {WINDOW}], ' ') AS rest
              FROM (SELECT row, words, unnest(range(len(words))) AS spot FROM d)
              WHERE words[spot + 1] IN (SELECT keyword FROM rule)),
        f AS (SELECT row, spot, rule, label, priority, base, weight,
                     len(string_split(rtrim(regexp_extract(rest, pattern)), ' ')) AS n
              FROM h JOIN rule ON word = keyword WHERE regexp_matches(rest, pattern)),
        k AS (SELECT *, NOT EXISTS (
                  SELECT 1 FROM f e WHERE e.row = f.row AND e.spot <= f.spot AND e.spot + e.n >= f.spot + f.n
                     AND CASE WHEN e.spot = f.spot AND e.n = f.n
                              THEN e.priority > f.priority OR (e.priority = f.priority AND e.rule < f.rule)
                              ELSE e.priority >= f.priority END) AS kept
              FROM f),
        s AS (SELECT row, count(*) FILTER (WHERE base) AS n_base, min(spot) FILTER (WHERE base) AS first_word,
                     max(spot) FILTER (WHERE base) AS last_word,
                     string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
                     string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base OR kept) AS labels,
                     max(weight) FILTER (WHERE kept) AS score
              FROM k GROUP BY row)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
        FROM d LEFT JOIN s USING (row)"""
