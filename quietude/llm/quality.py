"""Quality classifier: Naive Bayes support vectors.

Features are indicators of the n-grams that a text holds: byte n-grams (orders
``ORDERS``), hashed to ``DIMS`` indices, and n-grams of up to ``REPEATS`` signs
that say "this word is the one before it". Each indicator is scaled by its log-count
ratio between the classes, and a hinge-loss model is fitted to the scaled,
length-normalised indicators by dual coordinate descent. A sigmoid fitted on a
part of the sample that the model has not seen turns margins into scores.

Fitting takes a sample of about ``per_class`` labelled rows of each class (at
most four times ``per_class`` rows), chosen by a hash of the id. Every whole
text is scored; text is the only input of a score.

Defined cases: a NULL text counts as empty; an empty text is scored by the bias.
Labels that are NULL or belong to no document are not learned from; a document
with several labels is learned with each. With labels of one class only, every
score is that class; with none, 0.5. NULL ids are held out. An empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietude.llm.arrow_text import text_runs
from quietude.llm.common import quoted
from quietude.llm.language_id import sample_by_label
from quietude.llm.linear import fit_hinge, fit_sigmoid

DIMS = 1 << 18
ORDERS = (2, 4)
REPEATS = 6
SMOOTH = 1.0


def ngram_set(data: np.ndarray) -> np.ndarray:
    """Distinct hashed n-grams of one text, sorted."""
    parts = []
    c = data.astype(np.uint32)
    for order in ORDERS:
        if len(c) >= order:
            mixed = np.full(len(c) - order + 1, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for i in range(order):
                mixed = (mixed ^ c[i:len(c) - order + 1 + i]) * np.uint32(0x85EBCA6B)
            parts.append(REPEATS + (mixed ^ (mixed >> np.uint32(13))) % np.uint32(DIMS - REPEATS))
    words = data.tobytes().split()
    if len(words) > 1:
        last = np.flatnonzero(np.fromiter(map(ne, words, words[1:]), bool, len(words) - 1))
        run = int(np.diff(last, prepend=-1, append=len(words) - 1).max()) - 1
        parts.append(np.arange(min(run, REPEATS), dtype=np.uint32))
    return np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.empty(0, np.int32)


@dataclass(frozen=True)
class Model:
    """``weights`` are the SVM's, times the log-count ratios."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, grams: np.ndarray) -> float:
        return float(self.weights[grams].sum(dtype=np.float64)) / max(1.0, len(grams)) ** 0.5 + self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def fit_rows(grams: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fit on sets of n-grams and 0/1 labels (every fifth row fits the sigmoid)."""
    if not len(labels):
        return Model(np.zeros(DIMS, np.float32), 0.0, 0.0, 0.0)
    if labels.min() == labels.max():
        return Model(np.zeros(DIMS, np.float32), 0.0, 0.0, 30.0 if labels[0] else -30.0)
    calibrate = np.arange(len(labels)) % 5 == 0
    if len(set(labels[~calibrate])) < 2 or len(set(labels[calibrate])) < 2:
        calibrate[:] = True
        learn = np.arange(len(labels))
    else:
        learn = np.flatnonzero(~calibrate)
    hits = np.full((2, DIMS), SMOOTH)
    for i in learn:
        hits[int(labels[i]), grams[i]] += 1
    ratio = np.log(hits[1] / hits[1].sum()) - np.log(hits[0] / hits[0].sum())
    rows = [(grams[i], ratio[grams[i]] / max(1.0, len(grams[i])) ** 0.5) for i in learn]
    w, bias = fit_hinge(rows, np.where(labels[learn] > 0, 1.0, -1.0), DIMS, cost=1.0, epochs=12)
    plain = Model((w * ratio).astype(np.float32), bias, 1.0, 0.0)
    held = np.flatnonzero(calibrate)
    slope, shift = fit_sigmoid(np.array([plain.margin(grams[i]) for i in held]), labels[held].astype(float))
    return Model(plain.weights, bias, slope, shift)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = 2000) -> Model:
    """Fit on a bounded sample of the ``labels`` rows where ``learn`` holds."""
    known = (labels.where(learn).select(quoted(id_col).alias("l_id"), quoted(label_col).cast("int").alias("label"))
             .where("l_id IS NOT NULL AND label IN (0, 1)"))
    sample = sample_by_label(known, "label", F.col("l_id"), per_class)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngram_set(data[lo:hi]) for _, _, data, offsets in text_runs(batch.column(1))
                    for lo, hi in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int32())), batch.column(2)],
                                             names=["label", "grams", "l_id"])

    rows = (docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
            .join(F.broadcast(sample), F.col("id") == F.col("l_id")).select("label", "text", F.col("l_id").cast("string"))
            .limit(8 * per_class).mapInArrow(gathered, "label int, grams array<int>, l_id string").toPandas())
    rows = rows.sort_values(["l_id", "label"], kind="stable")
    return fit_rows([np.asarray(g, np.int64) for g in rows["grams"]], rows["label"].to_numpy())


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """id, score and predicted (1 from ``threshold`` on) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(quoted(text_col).cast("string").alias("text"), quoted(id_col).alias("id"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [shared.value.margin(ngram_set(data[lo:hi])) for _, _, data, offsets in text_runs(batch.column(0))
                       for lo, hi in zip(offsets[:-1], offsets[1:])]
            found = shared.value.score(np.array(margins, float))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                names=["id", "score", "predicted"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
