"""Exact top-k search by inner product with KD-trees per shard.

The candidates are dealt to shards of about ``shard_rows`` rows by row number.
Each shard builds a KD-tree: median splits on the widest dimension, with tight
bounding boxes. A query walks a tree best-first by the upper bound of its inner
product with a node's box, and stops when the best box left cannot beat its
k-th score. That score is propagated: a seed shard is searched first, and its
k-th score is the starting bound in every other shard; within a task it also
grows from shard to shard.

The queries come in blocks of ``block_rows`` rows against every shard, so the
work is queries x shards, in tasks of bounded memory. Nothing is broadcast.

Components are scaled to floor(scale * x), so scores are integers. They must
stay below 2**53 in absolute value, which is checked, since the leaf products
are taken in doubles.

Defined cases: vectors that are NULL, empty or hold NULL or non-finite components
take no part, nor do rows with a NULL id. All vectors must have one length.
Equal scores are ranked by the smaller id. A query's own row is every row with
its id. Rows repeated as candidates count once per row; repeated queries give
their result once. Fewer than k candidates give that many rows; an empty table
gives none. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.llm.common import quoted, stored

EXACT = float(1 << 53)


class KDTree:
    """Median-split tree over integer vectors, with each node's bounding box
    and smallest id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = 128) -> None:
        self.lo, self.hi, self.first_id, self.kids, self.rows = [], [], [], [], []
        order = np.arange(len(ids))
        todo = [(order, -1, 0)] if len(ids) else []
        while todo:
            rows, parent, side = todo.pop()
            here, at = vectors[rows], len(self.lo)
            lo, hi = here.min(axis=0), here.max(axis=0)
            self.lo.append(lo), self.hi.append(hi), self.first_id.append(ids[rows].min())
            self.kids.append([-1, -1]), self.rows.append(None)
            if parent >= 0:
                self.kids[parent][side] = at
            dim = int(np.argmax(hi - lo))
            if len(rows) <= leaf_rows or lo[dim] == hi[dim]:
                near = rows[np.argsort(ids[rows], kind="stable")]
                self.rows[at] = (ids[near], vectors[near])
                continue
            half = len(rows) // 2
            split = rows[np.argpartition(here[:, dim], half)]
            todo += [(split[:half], at, 0), (split[half:], at, 1)]
        if len(ids):
            self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def search(self, query: np.ndarray, own: int, k: int, best: list[tuple[float, int]]) -> None:
        """Add the tree's best to ``best``, a heap of (score, -id) of at most k."""
        if not len(self.lo):
            return
        bounds = (np.where(query > 0, self.hi, self.lo) * query).sum(axis=1)
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if len(best) == k and -bound < best[0][0]:
                return
            if len(best) == k and -bound == best[0][0] and self.first_id[node] > -best[0][1]:
                continue
            if self.rows[node] is None:
                for kid in self.kids[node]:
                    heapq.heappush(queue, (-bounds[kid], kid))
                continue
            ids, vectors = self.rows[node]
            scores = vectors @ query
            if len(best) == k:
                fit = np.flatnonzero(scores >= best[0][0])
                ids, scores = ids[fit], scores[fit]
            if len(scores) > k + 1:
                top = np.lexsort((ids, -scores))[:k + np.count_nonzero(ids == own)]
                ids, scores = ids[top], scores[top]
            for i, s in zip(ids.tolist(), scores.tolist()):
                if i != own and len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif i != own and (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))


def _unpack(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.float64).reshape(-1, width)


def _search(batches: Iterator[pa.RecordBatch], width: int, k: int, leaf_rows: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, ids, vectors, q_block, q_ids, q_vectors, q_bounds), a shard's rows together."""
    shard, tree = None, None
    known: dict[int, tuple[np.ndarray, ...]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            if r["shard"] != shard:
                tree = KDTree(np.frombuffer(r["ids"], np.int64), _unpack(r["vectors"], width), leaf_rows)
                shard = r["shard"]
            q_ids, q_vectors = np.frombuffer(r["q_ids"], np.int64), _unpack(r["q_vectors"], width)
            bounds = known.get(r["q_block"])
            if bounds is None:
                bounds = np.frombuffer(r["q_bounds"], np.float64).copy()
                if len(known) >= 64:
                    known.clear()
                known[r["q_block"]] = bounds
            out: list[tuple[int, int, int]] = []
            for n, (own, q) in enumerate(zip(q_ids.tolist(), q_vectors)):
                # Places held at the propagated score: a candidate must reach it to matter.
                best: list[tuple[float, int]] = [(bounds[n], -(1 << 63))] * k if np.isfinite(bounds[n]) else []
                tree.search(q, own, k, best)
                found = [(s, -i) for s, i in best if i != -(1 << 63)]
                if len(best) == k:
                    bounds[n] = max(bounds[n], best[0][0])
                out += [(own, i, int(s)) for s, i in found]
            if out:
                a = np.array(out, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a[:, c]) for c in range(3)],
                                                 names=["query_id", "vec_id", "score"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    return found.withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)")).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: str, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = 8192, block_rows: int = 1024,
          leaf_rows: int = 128) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best candidates.

    ``queries`` is a SQL condition on ``id`` that marks the query rows.
    """
    spark = vectors.sparkSession
    clean = (vectors.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).cast("array<double>").alias("v"))
             .where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND "
                    "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
             .select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"),
                     F.monotonically_increasing_id().alias("row")))
    rows = stored(clean, "vectors")
    n, narrow, wide, largest = rows.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v")),
                                        F.max(F.expr("array_max(transform(v, x -> abs(x)))"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], schema)
    if narrow != wide:
        raise ValueError(f"vectors have {narrow} to {wide} components")
    if wide * largest * largest >= EXACT:
        raise ValueError("scores do not fit; choose a smaller scale")

    def packed(key: str, name: str, source: DataFrame) -> DataFrame:
        def pack(group: pd.DataFrame) -> pd.DataFrame:
            matrix = np.stack(group["v"].to_numpy()).astype(np.float64)
            return pd.DataFrame({name: [group[name].iloc[0]], "ids": [group["id"].to_numpy(np.int64).tobytes()],
                                 "vectors": [matrix.tobytes()]})
        return (source.withColumn(name, F.expr(key)).groupBy(name)
                .applyInPandas(pack, f"{name} long, ids binary, vectors binary"))

    # Row numbers of one input task are consecutive from (task << 33).
    shards = max(1, -(-n // shard_rows))
    shard_key = f"pmod((row & ((1L << 33) - 1)) + 7919L * shiftright(row, 33), {shards}L)"
    shard_table = stored(packed(shard_key, "shard", rows), "shards")
    asked = rows.where(queries).dropDuplicates(["id"])
    blocks = max(1, -(-rows.where(queries).count() // block_rows))
    query_table = stored(packed(f"pmod(xxhash64(id), {blocks}L)", "block", asked).selectExpr(
        "block AS q_block", "ids AS q_ids", "vectors AS q_vectors"), "queries")

    def search(pairs: DataFrame) -> DataFrame:
        return pairs.mapInArrow(lambda it: _search(it, wide, k, leaf_rows), "query_id long, vec_id long, score long")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def against(shard_rows_: DataFrame, ids: str, bounded: DataFrame) -> DataFrame:
        pairs = bounded.withColumn("q_shard", F.explode(F.expr(ids)))
        return (pairs.join(shard_rows_.hint("shuffle_merge"), F.col("q_shard") == F.col("shard"))
                .select("shard", "ids", "vectors", "q_block", "q_ids", "q_vectors", "q_bounds")
                .sortWithinPartitions("shard", "q_block"))

    # Seed: each block against one shard, without a bound.
    seed = stored(search(query_table.withColumn("q_shard", F.pmod("q_block", F.lit(shards)))
                         .join(shard_table.hint("shuffle_merge"), F.col("q_shard") == F.col("shard"))
                         .select("shard", "ids", "vectors", "q_block", "q_ids", "q_vectors", F.lit(b"").alias("q_bounds"))
                         .mapInArrow(_no_bounds, "shard long, ids binary, vectors binary, q_block long, "
                                                 "q_ids binary, q_vectors binary, q_bounds binary")), "seed")
    kth = seed.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    per_block = (kth.where(F.col("n") == k).selectExpr(f"pmod(xxhash64(query_id), {blocks}L) AS k_block", "query_id", "kth")
                 .groupBy("k_block").agg(F.collect_list(F.struct("query_id", "kth")).alias("known")))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for ids, known in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                have = {r["query_id"]: r["kth"] for r in known or []}
                blobs.append(np.array([have.get(i, -np.inf) for i in np.frombuffer(ids, np.int64).tolist()],
                                      np.float64).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(blobs, pa.binary())],
                                             names=["q_block", "q_ids", "q_vectors", "q_bounds"])

    bounded = stored(query_table.join(per_block, F.col("q_block") == F.col("k_block"), "left")
                     .select("q_block", "q_ids", "q_vectors", "known")
                     .mapInArrow(fill, "q_block long, q_ids binary, q_vectors binary, q_bounds binary"), "bounded")
    rest = search(against(shard_table, f"filter(sequence(0L, {shards - 1}L), s -> s != pmod(q_block, {shards}L))", bounded))
    return _ranked(seed.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def _no_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fill q_bounds with minus infinity for every query of the block."""
    for batch in batches:
        blobs = [np.full(len(ids) // 8, -np.inf).tobytes() for ids in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(blobs, pa.binary())],
                                         names=[*batch.schema.names[:6], "q_bounds"])
