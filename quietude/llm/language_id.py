"""Language identification by hierarchical discrimination.

Features are byte trigrams of the text (letters lower-cased, other ASCII as
blanks, bytes beyond ASCII as they are), hashed to ``DIMS`` indices, as shares
of the text's trigrams. Linear SVMs vote one-versus-one, first between
language families, then between the languages of the winning family. Text
is the only input of a prediction.

The duels can't say "none of these": one language always wins. ``keep_known``
therefore also asks how likely a text's trigrams are in the learned languages. Its
mean log chance per trigram, in the language where it is highest, must be nearer to
that of labelled texts left out of the counts (their median) than to that of trigrams
drawn evenly, less ``SLACK`` standard errors of a text of its length. A text
of few trigrams can't be told from a learned language and stays.

The models are fitted on a sample of labelled rows: about ``per_language`` rows
of each language, taken by a hash of the id from all labelled rows, never more
than ``2 * per_language * languages`` rows. Prediction covers every whole text.

Defined cases: a NULL text or one without a letter gives ``und`` with score 0.
Rows with a NULL language are not learned from. With one language only it is
the prediction for every text with a letter, with score 1; with none, ``und``.
NULL ids are held out. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietude.llm.arrow_text import RUN_BYTES, text_runs
from quietude.llm.common import quoted
from quietude.llm.linear import fit_hinge

DIMS = 1 << 16
SLACK = 3.0
JUDGED_BYTES = 1 << 18  # of short texts judged together: the sums of each language take eight bytes a letter
MOST = 2000  # trigrams of one text that count towards a language's chances
SCALE = 100.0  # shares of trigrams are small; one unit of the models' features is a hundredth

#: Families of languages (fixed values); a language not listed is a family of its own.
FAMILIES = {"en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
            "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ca": "romance", "ro": "romance"}

_BLANK = 32
_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[:128] = [b | 32 if chr(b).isalpha() else _BLANK for b in range(128)]


def trigram_codes(data: np.ndarray) -> np.ndarray:
    """Hashed trigram code at each byte but the last two."""
    c = _CLASS[data]
    mixed = (c[:-2] * np.uint32(2654435761)) ^ (c[1:-1] * np.uint32(2246822519)) ^ (c[2:] * np.uint32(3266489917))
    return ((mixed ^ (mixed >> np.uint32(15))) & np.uint32(DIMS - 1)).astype(np.int32)


def code_runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Trigram codes and text offsets of a run; a text longer than a run comes in pieces
    of ``RUN_BYTES``, which overlap by two bytes so that no trigram is lost."""
    if len(offsets) > 2 or len(data) <= RUN_BYTES:
        yield trigram_codes(data), offsets
    else:
        for lo in range(0, len(data) - 2, RUN_BYTES):
            piece = data[lo:lo + RUN_BYTES + 2]
            yield trigram_codes(piece), np.array([0, len(piece)])


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Duel:
    """A one-versus-one model: a positive margin is a vote for ``plus``."""

    plus: str
    minus: str
    row: int


@dataclass(frozen=True)
class Model:
    """Duels between families and, per family, between its languages; row i of
    ``weights`` and ``bias`` is the i-th duel's."""

    families: Mapping[str, tuple[str, ...]]
    family_duels: tuple[Duel, ...]
    language_duels: Mapping[str, tuple[Duel, ...]]
    weights: np.ndarray
    bias: np.ndarray
    #: Log chance of each trigram (languages, DIMS); the median of labelled texts' means
    #: and the deviation within texts.
    chance: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMS), np.float32))
    usual: float = 0.0
    spread: float = 0.0

    def learned(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each text of a run can be of a learned language."""
        out = np.ones(len(offsets) - 1, bool)
        if len(data) < 3 or not len(self.chance):
            return out
        length = np.maximum(np.diff(offsets) - 2, 0)
        sums = np.zeros((len(self.chance), len(length)))
        for codes, edges in code_runs(data, offsets):
            lo = np.minimum(edges[:-1], len(codes))
            hi = np.minimum(lo + np.maximum(np.diff(edges) - 2, 0), len(codes))
            for own, own_sums in zip(self.chance, sums):
                total = np.concatenate([[0.0], np.cumsum(own[codes], dtype=np.float64)])
                own_sums += total[hi] - total[lo]
        sums = sums.max(axis=0)
        n = np.maximum(length, 1)
        floor = (self.usual - np.log(DIMS)) / 2 - SLACK * self.spread / np.sqrt(n)
        return (length == 0) | (sums / n >= floor)

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Margins (texts, duels) of a run of texts."""
        out = np.tile(self.bias, (len(offsets) - 1, 1))
        if len(data) < 3 or not len(self.weights):
            return out
        size = np.maximum(np.diff(offsets) - 2, 1)
        for codes, edges in code_runs(data, offsets):
            for n, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                if hi - lo >= 3:
                    out[n] += self._weighed(codes[lo:hi - 2]) * (SCALE / size[n])
        return out

    def _weighed(self, codes: np.ndarray) -> np.ndarray:
        """Sum of each duel's weights over the codes; many codes are counted first."""
        if len(codes) <= DIMS:
            return self.weights[:, codes].sum(axis=1, dtype=np.float64)
        return self.weights @ np.bincount(codes, minlength=DIMS).astype(np.float64)

    def decide(self, margins: np.ndarray) -> tuple[str, float]:
        if not self.families:
            return "und", 0.0
        family, sure = _vote(sorted(self.families), self.family_duels, margins)
        language, surer = _vote(self.families[family], self.language_duels[family], margins)
        return language, sure * surer


def _vote(names, duels, margins) -> tuple[str, float]:
    """The name with most votes (ties: largest sum of margins, then the name)
    and the chance that it wins its weakest duel."""
    votes = dict.fromkeys(names, 0)
    total = dict.fromkeys(names, 0.0)
    for d in duels:
        m = float(margins[d.row])
        votes[d.plus if m > 0 else d.minus] += 1
        total[d.plus] += m
        total[d.minus] -= m
    best = max(sorted(names, reverse=True), key=lambda n: (votes[n], total[n]))
    own = [float(margins[d.row]) * (1 if d.plus == best else -1) for d in duels if best in (d.plus, d.minus)]
    return best, 1.0 / (1.0 + float(np.exp(-2.0 * np.clip(min(own), -20, 20)))) if own else 1.0


def _log_chances(features, sizes, lang, keep) -> np.ndarray:
    """Log chance of each trigram in each language, from the texts that ``keep`` marks."""
    out = []
    for name in sorted(set(lang[keep])):
        counts = np.zeros(DIMS)
        for k in np.flatnonzero(keep & (lang == name)):
            at, value = features[k]
            counts[at] += value * (min(sizes[k], MOST) / SCALE)
        out.append(np.log((counts + 0.1) / (counts.sum() + 0.1 * DIMS)).astype(np.float32))
    return np.array(out)


def _calibrated(features, sizes, lang) -> tuple[np.ndarray, float, float]:
    """Log chances, and the median and the deviation within texts on texts that another half's counts judge."""
    filled = np.array([n > 0 for n in sizes], bool)
    if not filled.any():
        return np.zeros((0, DIMS), np.float32), 0.0, 0.0
    order = np.zeros(len(lang), np.int64)  # number of the text among its language's
    for name in set(lang):
        order[lang == name] = np.arange((lang == name).sum())
    means, variances = [], []
    for half in (0, 1):
        learn = filled & (order % 2 == half)
        table = _log_chances(features, sizes, lang, learn if learn.any() else filled)
        for k in np.flatnonzero(filled & (order % 2 != half)):
            at, value = features[k]
            share = value / SCALE
            own = max((row[at] for row in table), key=lambda x: float(share @ x))
            mean = float(share @ own)
            means.append(mean)
            variances.append(float(share @ (own - mean) ** 2))
    return _log_chances(features, sizes, lang, filled), float(np.median(means)), float(np.sqrt(np.median(variances)))


def sample_by_label(rows: DataFrame, label: str, key: Column, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label, by a hash of ``key``; at most
    twice that in all. Few labels are expected: their counts come here."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0)
    keep = F.lit(False)
    draw = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30))
    for value, n in sorted(counts.items()):
        keep = keep | ((F.col(label) == F.lit(value)) & (draw < int(min(1.0, per_label / n) * (1 << 30))))
    return rows.where(keep).limit(2 * per_label * len(counts))


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        families: Mapping[str, str] = FAMILIES, per_language: int = 1000) -> Model:
    """Fit on a bounded sample of the rows where ``learn`` holds."""
    rows = (docs.where(learn).select(quoted(id_col).alias("id"), quoted(text_col).alias("text"),
                                     quoted(lang_col).alias("lang"))
            .where("lang IS NOT NULL AND text IS NOT NULL"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, value, size = [], [], []
            for _, _, data, offsets in text_runs(batch.column(1)):
                for lo, hi in zip(offsets[:-1], offsets[1:]):
                    codes, n = np.unique(trigram_codes(data[lo:hi]), return_counts=True) if hi - lo >= 3 else ((), ())
                    at.append(np.asarray(codes, np.int32))
                    value.append(np.asarray(n, np.float32) * (SCALE / max(1, hi - lo - 2)))
                    size.append(max(0, hi - lo - 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(value, pa.list_(pa.float32())), pa.array(size, pa.int64())],
                                             names=["lang", "at", "value", "size"])

    sample = (sample_by_label(rows, "lang", F.col("id"), per_language).select("lang", "text")
              .mapInArrow(counted, "lang string, at array<int>, value array<float>, size long").toPandas())
    languages = sorted(sample["lang"].unique())
    groups: dict[str, tuple[str, ...]] = {}
    for lang in languages:
        name = families.get(lang, lang)
        groups[name] = (*groups.get(name, ()), lang)
    features = [(np.asarray(a, np.int64), np.asarray(v, np.float64)) for a, v in zip(sample["at"], sample["value"])]
    lang = sample["lang"].to_numpy()
    family = np.array([families.get(x, x) for x in lang], dtype=object)
    weights, bias = [], []

    def duels(names, of) -> tuple[Duel, ...]:
        out = []
        for i, a in enumerate(names):
            for b in names[i + 1:]:
                rows_ = [n for n, x in enumerate(of) if x in (a, b)]
                y = np.array([1.0 if of[n] == a else -1.0 for n in rows_])
                w, b0 = fit_hinge([features[n] for n in rows_], y, DIMS, cost=1.0, epochs=15)
                out.append(Duel(a, b, len(weights)))
                weights.append(w.astype(np.float32))
                bias.append(b0)
        return tuple(out)

    family_duels = duels(sorted(groups), family)
    language_duels = {g: duels(names, lang) for g, names in groups.items()}
    return Model(groups, family_duels, language_duels,
                 np.array(weights, np.float32).reshape(len(weights), DIMS), np.array(bias),
                 *_calibrated(features, sample["size"].to_numpy(), lang))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """id, the ``keep`` columns, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(quoted(text_col).cast("string").alias("text"), quoted(id_col).alias("id"),
                       *[quoted(c).alias(f"keep_{i}") for i, c in enumerate(keep)])

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for lo, hi, data, offsets in text_runs(batch.column(0)):
                texts = batch.column(0).slice(lo, hi - lo)
                for text, margins in zip(texts, shared.value.margins(data, offsets)):
                    lang, score = shared.value.decide(margins) if has_letter(text.as_py()) else ("und", 0.0)
                    langs.append(lang)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names[1:], "lang_pred", "score"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    out = rows.mapInArrow(labelled, f"{fields}, lang_pred string, score double")
    return out.toDF(id_col, *keep, "lang_pred", "score")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.2,
               languages: frozenset[str] | None = None) -> DataFrame:
    """The rows of ``docs`` whose text has a recognised language: not ``und``, trigrams
    that a learned language can have, a score of at least ``min_score`` (from 0.25 on it
    rejects texts that the duels are unsure of) and, if given, one of ``languages``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        mask = []
        for lo, hi, data, offsets in text_runs(texts, JUDGED_BYTES):
            for text, margins, learned in zip(texts.slice(lo, hi - lo), shared.value.margins(data, offsets),
                                              shared.value.learned(data, offsets)):
                lang, score = shared.value.decide(margins) if learned and has_letter(text.as_py()) else ("und", 0.0)
                mask.append(lang != "und" and score >= min_score and (languages is None or lang in languages))
        return pa.array(mask, pa.bool_())

    return docs.where(known(quoted(text_col).cast("string")))  # only the texts go to Python, and a verdict back


def fold(id_col: Column, folds: int, missing: int) -> Column:
    """crc32 of the id's text modulo ``folds``; ``missing`` for a NULL id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds, F.lit(missing))
