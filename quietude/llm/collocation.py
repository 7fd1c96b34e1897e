"""Collocations of two and three words by stripes.

A stripe is an associative counter: a prefix of words, and how often each word
follows it. The stripes of the empty prefix, of words and of pairs of words
form one structure: an entry of a stripe counts the phrase "prefix + word", is
the total of that longer prefix, and the largest entry of a stripe says how
far a longer phrase subsumes the prefix.

Each task counts the stripes of its texts in memory and emits them whenever
``FLUSH`` words have gathered (one row per prefix, not per phrase). They are
merged elementwise after a shuffle by prefix. A prefix is followed by any
number of words, so its stripe is cut in parts by a hash of the next word: the
empty prefix in ``ROOT_PARTS``, a prefix with more than 1 in ``HOT`` of all
words in as many parts as it has shares of that size (there are at most
``HOT`` such prefixes in a language), any other in one.

Three passes over the texts count the prefixes of no, one and two words. A
phrase of ``least`` occurrences has only parts with as many, so a pass counts
the phrases whose parts may be frequent enough, by a bitmap of at most
``MAX_BITS`` bits; what a full bitmap lets through is merged and dropped.

Words are compared by bytes. Defined cases: a NULL text is empty, a NULL
language is ``und``. Repeated rows count each. Texts and words of any length
are taken whole, in slices of some ``SLICE`` bytes. An empty table or one
without words gives no rows. Extra columns, also ones named like the
result's, are ignored. Counts are exact; scores are exact up to
5 * 10**15 occurrences of a phrase and raise an error beyond.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietude.llm.common import LOWER, UPPER, quoted, stored

BREAKS = ".,;:!?\n\x0b\x0c\r"  # what ends a piece
FLUSH = 1 << 20
SLICE = 1 << 20  # with FLUSH, fewer than 2**21 words gather, so three of them fit an int64
ROOT_PARTS = 512
HOT = 2000
MAX_BITS = 1 << 27

_END = b"."  # stands between pieces; no word holds it
_PLAIN = bytes.maketrans((UPPER + BREAKS).encode(), (LOWER + "." * len(BREAKS)).encode())
# Odd factors that tell the words of a phrase apart in its filter cell.
_FACTORS = (1, 40503, 30011)
_STRIPES = "lang string, prefix binary, part int, words binary, counts binary, most long"
_DIGITS = [b"%d" % i for i in range(1000)]


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, with ``_END`` between pieces, in lists of about ``SLICE`` bytes."""
    text = text.translate(_PLAIN)
    start = 0
    while start < len(text):
        stop = start + SLICE
        if stop < len(text):  # cut where no word is
            cuts = [c for c in (text.find(b, stop) for b in (b" ", b"\t", _END)) if c >= 0]
            stop = min(cuts, default=len(text))
        yield text[start:stop].replace(_END, b" . ").split()  # of white space only blanks and tabs are left
        start = stop


def cell(hashes: list, lang: int, bits: int):
    """The filter cell of a phrase, from the CRC-32 of its words."""
    total = lang * 7919
    for h, factor in zip(hashes, _FACTORS):
        total = total + h * factor
    return total % bits


def phrase_filter(phrases: DataFrame, rows: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """A bitmap of the phrases (lang, words): some 16 bits for each of ``rows``."""
    bits = min(max_bits, 1 << max(15, math.ceil(math.log2(max(1, rows) * 16))))
    crc = F.transform("words", lambda w: F.crc32(w.cast("binary")))
    total = F.aggregate(F.zip_with(crc, F.array(*[F.lit(f).cast("long") for f in _FACTORS]), lambda h, f: F.coalesce(h * f, F.lit(0))),
                        F.crc32(F.col("lang").cast("binary")) * 7919, lambda a, x: a + x)
    cells = phrases.select((F.pmod(total, F.lit(bits)) + 1).alias("cell"))
    parts = (cells.groupBy(F.expr("bitmap_bucket_number(cell)").alias("bucket"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell))").alias("bitmap")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in parts:
        out[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(r["bitmap"], np.uint8)
    return out


def _held(bitmap: np.ndarray, hashes: list[np.ndarray], lang: int) -> np.ndarray:
    cells = cell(hashes, lang, len(bitmap) * 8)
    return (bitmap[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)


class _Counter:
    """Stripes of one language in one task."""

    def __init__(self, lang: str, size: int, bitmap, parts: dict[bytes, int]):
        self.lang, self.size, self.bitmap, self.parts = lang, size, bitmap, parts
        self.lang_crc = zlib.crc32(lang.encode())
        self.kept: list[bytes] = []  # the last words of a text that goes on
        self.clear()

    def clear(self) -> None:
        self.ids: defaultdict[bytes, int] = defaultdict(itertools.count(1).__next__)
        self.arrays: list[np.ndarray] = []
        self.n = 0
        self.add(self.kept)

    def add(self, words: list[bytes]) -> None:
        self.ids[_END]  # always 1
        self.arrays.append(np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words)))
        self.n += len(words)

    def flush(self, goes_on: bool) -> Iterator[pa.RecordBatch]:
        """The stripes of what has gathered."""
        seq = np.concatenate(self.arrays)
        names = [b"", *self.ids]
        k = self.size
        self.kept = [names[i] for i in seq[len(seq) - k:]] if goes_on and k else []
        yield from self._stripes(seq, names)
        self.clear()

    def _stripes(self, seq: np.ndarray, names: list[bytes]) -> Iterator[pa.RecordBatch]:
        k, m = self.size, len(seq) - self.size
        if m <= 0:
            return
        v = len(names)
        columns = [seq[i:m + i] for i in range(k + 1)]
        good = columns[0] != 1
        for c in columns[1:]:
            good &= c != 1
        crc = np.fromiter(map(zlib.crc32, names), np.int64, v)
        if k:  # all but the last and all but the first word may be a frequent phrase
            may = _held(self.bitmap, [crc[seq[i:len(seq) - k + 1 + i]] for i in range(k)], self.lang_crc)
            good &= may[:m] & may[1:]
        code = columns[0][good]
        for c in columns[1:]:
            code = code * v + c[good]
        code, counts = np.unique(code, return_counts=True)
        if not len(code):
            return
        before, word = code // v, code % v
        starts = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        words, numbers = [names[w] for w in word], [_DIGITS[c] if c < 1000 else b"%d" % c for c in counts.tolist()]
        most = np.maximum.reduceat(counts, starts).tolist()
        heads = before[starts]
        if k < 2:
            prefixes = [names[h] if k else b"" for h in heads]
        else:
            prefixes = [names[x] + b" " + names[y] for x, y in zip(heads // v, heads % v)]
        ends = [*starts[1:].tolist(), len(words)]
        columns = [[], [], [], [], []]  # prefix, part, words, counts, most
        whole = []
        for i, prefix in enumerate(prefixes):
            shares = self.parts.get(prefix, 1) if k else ROOT_PARTS
            if shares == 1:
                whole.append(i)
                continue
            dealt = defaultdict(list)
            for j in range(starts[i], ends[i]):
                dealt[int(crc[word[j]]) % shares].append(j)
            for part, own in dealt.items():
                row = (prefix, part, b" ".join([words[j] for j in own]), b" ".join([numbers[j] for j in own]), int(counts[own].max()))
                for column, value in zip(columns, row):
                    column.append(value)
        spans = [(starts[i], ends[i]) for i in whole] if len(whole) < len(prefixes) else list(zip(starts.tolist(), ends))
        columns[0] += [prefixes[i] for i in whole]
        columns[1] += [0] * len(whole)
        columns[2] += [b" ".join(words[x:y]) for x, y in spans]
        columns[3] += [b" ".join(numbers[x:y]) for x, y in spans]
        columns[4] += [most[i] for i in whole]
        yield from _batches([self.lang] * len(columns[0]), *columns)


def _batches(*columns: list, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
    names = ("lang", "prefix", "part", "words", "counts", "most")
    for i in range(0, len(columns[0]), most):
        yield pa.RecordBatch.from_arrays([pa.array(c[i:i + most], t) for c, t in zip(columns, kinds)], names)


def _counted(size: int, bitmap, parts: dict[str, dict[bytes, int]]):
    """Texts (lang, text) to the stripes of prefixes of ``size`` words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, _Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                c = counters.get(lang)
                if c is None:
                    c = counters[lang] = _Counter(lang, size, bitmap, parts.get(lang, {}))
                for words in tokens(text.as_py()):
                    c.add(words)
                    if c.n >= FLUSH:
                        yield from c.flush(goes_on=True)
                c.add([_END])
                c.kept = []
            # Few rows gather in many counters: their sum is bounded too.
            if sum(c.n for c in counters.values()) >= 2 * FLUSH:
                for c in counters.values():
                    yield from c.flush(goes_on=False)
                counters = {}
        for c in counters.values():
            yield from c.flush(goes_on=False)

    return count


def _elementwise(run: list[tuple[bytes, bytes]]) -> dict[bytes, int]:
    """The sum of stripes."""
    total: dict[bytes, int] = {}
    for words, counts in run:
        words, numbers = words.split(b" "), map(int, counts.split(b" "))
        if not total:
            total = dict(zip(words, numbers))
        else:
            for w, n in zip(words, numbers):
                total[w] = total.get(w, 0) + n
    return total


def _merged(least: int):
    """Sorted stripes to one row per (lang, prefix, part): entries of ``least``
    or more, and in ``total`` the sum of all. Rows of a prefix whose largest
    entries don't add up to ``least`` have no such entry."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            key, run, reach = None, [], 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                lang, prefix, part = batch.column(0), batch.column(1), batch.column(2).to_numpy()
                most = np.where(pc.equal(pc.binary_length(prefix), 0), least, batch.column(5).to_numpy())  # all of the empty prefix
                n = len(part)
                new = np.r_[(prefix[0].as_py(), int(part[0]), lang[0].as_py()) != key, part[1:] != part[:-1]]
                for c in (lang, prefix):
                    new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(new)
                head = int(starts[0]) if len(starts) else n
                if head:  # goes on with the run before
                    run += zip(batch.column(3).slice(0, head).to_pylist(), batch.column(4).slice(0, head).to_pylist())
                    reach += int(most[:head].sum())
                if not len(starts):
                    continue
                if reach >= least:
                    yield key, _elementwise(run)
                sums = np.add.reduceat(most, starts)
                sums[-1] = max(sums[-1], least)  # the last run may go on
                chosen, ends = np.flatnonzero(sums >= least), np.r_[starts[1:], n]
                lengths = (ends - starts)[chosen]
                rows = pa.array(np.repeat(starts[chosen] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum()))
                words, counts = batch.column(3).take(rows).to_pylist(), batch.column(4).take(rows).to_pylist()
                firsts = pa.array(starts[chosen])
                keys = zip(prefix.take(firsts).to_pylist(), part[starts[chosen]].tolist(), lang.take(firsts).to_pylist())
                at = 0
                for i, (key, length) in enumerate(zip(keys, lengths.tolist())):
                    run = list(zip(words[at:at + length], counts[at:at + length]))
                    at += length
                    if i < len(lengths) - 1:
                        yield key, _elementwise(run)
                reach = int(most[starts[-1]:].sum())
            if reach >= least:
                yield key, _elementwise(run)

        def rows() -> Iterator[tuple]:
            for (prefix, part, lang), stripe in out():
                frequent = [(w, n) for w, n in stripe.items() if n >= least]
                if frequent or not prefix:
                    yield lang, prefix, part, [w for w, _ in frequent], [n for _, n in frequent], sum(stripe.values())

        kinds = (pa.string(), pa.binary(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.int64())
        names = ("lang", "prefix", "part", "words", "counts", "total")
        done = rows()
        while batch := list(itertools.islice(done, 5000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batch), kinds)], names)

    return merge


def stripes(texts: DataFrame, size: int, least: int, bitmap=None, parts: dict[str, dict[bytes, int]] | None = None) -> DataFrame:
    """The merged stripes of all prefixes of ``size`` words: lang, prefix, part,
    words and counts (the frequent entries) and total.

    ``texts``: lang string, text binary; ``parts``: in how many parts the
    stripes of hot prefixes are cut, by language."""
    local = texts.mapInArrow(_counted(size, bitmap, parts or {}), _STRIPES)
    dealt = local.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
    merged = dealt.mapInArrow(_merged(least), "lang string, prefix binary, part int, words array<binary>, counts array<long>, total long")
    return stored(merged.withColumn("prefix", F.col("prefix").cast("string"))
                  .withColumn("words", F.col("words").cast("array<string>")), f"stripes{size}")


def entries(found: DataFrame) -> DataFrame:
    """One row per entry of stripes: lang, prefix, word, f."""
    return found.select("lang", "prefix", F.explode(F.arrays_zip("words", "counts")).alias("e")).select(
        "lang", "prefix", F.col("e.words").alias("word"), F.col("e.counts").alias("f"))


def _hot(phrases: DataFrame, phrase: Column, totals: DataFrame) -> dict[str, dict[bytes, int]]:
    """By language the phrases with more than 1 in HOT of its words (at most HOT
    each), and how many shares of that size they have."""
    share = F.floor(F.col("f") * HOT / F.col("n")).cast("int")
    rows = phrases.join(totals, "lang").where(F.col("f") * HOT > F.col("n")).select("lang", phrase.alias("phrase"), share.alias("share"))
    out: dict[str, dict[bytes, int]] = defaultdict(dict)
    for r in rows.collect():
        out[r["lang"]][r["phrase"].encode()] = r["share"] + 1
    return dict(out)


def collocations(docs: DataFrame, least: int = 10, subsumed: int = 50, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of two and three words that occur ``least`` times or
    more. Cut in two, a phrase scores floor(10**6 * a * a / (l * r)), for its a
    and its parts' l and r occurrences; its weakest cut counts. Candidates are
    dropped if a longer one that holds them has ``subsumed`` percent of their
    occurrences or more."""
    texts = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(quoted(text_col), F.lit("")).cast("binary").alias("text"))
    roots = stripes(texts, 0, least)
    totals = stored(roots.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    one = entries(roots).select("lang", "word", "f")
    bitmap = phrase_filter(one.select("lang", F.array("word").alias("words")), one.count())
    firsts = stripes(texts, 1, least, bitmap, _hot(one, F.col("word"), totals))
    two = entries(firsts)
    bitmap = phrase_filter(two.select("lang", F.array("prefix", "word").alias("words")), two.count())
    seconds = stripes(texts, 2, least, bitmap, _hot(two, F.concat_ws(" ", "prefix", "word"), totals))

    single = one.select("lang", F.col("word").alias("w"), F.col("f").alias("fw"))
    double = two.select("lang", F.col("prefix").alias("w1"), F.col("word").alias("w2"), F.col("f").alias("a"))
    triple = (entries(seconds).withColumn("pair", F.split("prefix", " "))
              .select("lang", F.col("pair")[0].alias("w1"), F.col("pair")[1].alias("w2"), F.col("word").alias("w3"), F.col("f").alias("a")))

    def known(df: DataFrame, *words: str, to: str) -> DataFrame:
        """Add the occurrences of the phrase in these columns."""
        if len(words) == 1:
            side, names = single, ["w"]
        else:
            side, names = double.withColumnRenamed("a", "fw"), ["w1", "w2"]
        side = side.select(F.col("lang").alias("_lang"), *[F.col(n).alias(f"_{n}") for n in names], F.col("fw").alias(to))
        on = F.col("lang") == F.col("_lang")
        for w, n in zip(words, names):
            on &= F.col(w) == F.col(f"_{n}")
        return df.join(side, on).drop("_lang", *[f"_{n}" for n in names])

    # How far longer candidates subsume a pair: by its own stripe, and by those that end with it.
    longer = (seconds.select("lang", "prefix", F.array_max("counts").alias("m"))
              .unionByName(triple.select("lang", F.concat_ws(" ", "w2", "w3").alias("prefix"), F.col("a").alias("m")))
              .groupBy("lang", "prefix").agg(F.max("m").alias("m")).select(F.col("lang").alias("_lang"), "prefix", "m"))
    pairs = double.join(longer, (F.col("lang") == F.col("_lang")) & (F.concat_ws(" ", "w1", "w2") == F.col("prefix")), "left")
    pairs = pairs.where(F.col("m").isNull() | (F.col("m") * 100 < F.col("a") * subsumed)).select("lang", "w1", "w2", "a")
    pairs = known(known(pairs, "w1", to="l"), "w2", to="r")
    exact = "CAST(1000000 * CAST(a AS DECIMAL(20, 0)) * CAST(a AS DECIMAL(16, 0)) AS DECIMAL(38, 0))"

    def score(left: str, right: str) -> str:
        return f"CAST({exact} div (CAST({left} AS DECIMAL(19, 0)) * CAST({right} AS DECIMAL(19, 0))) AS BIGINT)"

    pairs = pairs.selectExpr("lang", "concat_ws(' ', w1, w2) AS phrase", "a", "l", "r", f"{score('l', 'r')} AS score")
    triples = known(known(triple, "w1", to="l1"), "w3", to="r2")
    triples = known(known(triples, "w1", "w2", to="l2"), "w2", "w3", to="r1")
    triples = triples.selectExpr("lang", "concat_ws(' ', w1, w2, w3) AS phrase", "a", "l1", "r1", "l2", "r2",
                                 f"{score('l1', 'r1')} AS s1", f"{score('l2', 'r2')} AS s2")
    triples = triples.selectExpr("lang", "phrase", "a", "IF(s1 <= s2, l1, l2) AS l", "IF(s1 <= s2, r1, r2) AS r", "least(s1, s2) AS score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = pairs.unionByName(triples).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = 10, subsumed: int = 50, top: int = 2000) -> str:
    """DuckDB SQL for ``collocations`` over ``documents``."""
    return rf"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
                translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda w: w <> '') AS w
            FROM documents),
        g AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p)),
        f1 AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
        f2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
        f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
        t AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang),
        longer AS (SELECT lang, w1, w2, max(f) AS m FROM (
                       SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) WHERE f >= {least} GROUP BY ALL),
        c AS (
            SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r,
                   CAST(1000000 AS HUGEINT) * f2.f * f2.f // (CAST(x.f AS HUGEINT) * y.f) AS score
            FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
                 LEFT JOIN longer ON longer.lang = f2.lang AND longer.w1 = f2.w1 AND longer.w2 = f2.w2
            WHERE f2.f >= {least} AND (m IS NULL OR 100 * m < {subsumed} * f2.f)
            UNION ALL
            SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
            FROM (SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.f AS a, x.f AS l1, yy.f AS r1, xx.f AS l2, y.f AS r2,
                         CAST(1000000 AS HUGEINT) * f3.f * f3.f // (CAST(x.f AS HUGEINT) * yy.f) AS s1,
                         CAST(1000000 AS HUGEINT) * f3.f * f3.f // (CAST(xx.f AS HUGEINT) * y.f) AS s2
                  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3
                       JOIN f2 xx ON xx.lang = f3.lang AND xx.w1 = f3.w1 AND xx.w2 = f3.w2
                       JOIN f2 yy ON yy.lang = f3.lang AND yy.w1 = f3.w2 AND yy.w2 = f3.w3
                  WHERE f3.f >= {least})),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM c)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN t USING (lang) WHERE rank <= {top}"""
