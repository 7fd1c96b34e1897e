"""Mixing sources to target weights.

Every source's documents, in a fixed pseudorandom order, form one stream of
words that is packed into blocks of ``block_words``. The mix is a sequence of
slots, cut into output shards. Each shard draws how many slots every source
gets from a multinomial over what the sources still have to give; the draws
split a binary tree of shards, so any shard finds its counts and the index of
its first slot per source by walking one path from the root, without the other
shards. Slot j of a source takes block ``perm(j mod blocks)``, where ``perm``
is a pseudorandom permutation of the source's block indices, a new one for
each pass. Blocks join documents by (source, block index).

A source with target t and size s gives ``round(blocks * t / s)`` slots, so its
taken words differ from the target by about one block. Targets stop at twice
the size: two passes, so no document is taken more than twice.

Only the size of each source comes to the driver. The number of sources is
that of a weight table, bounded by ``MAX_SOURCES``.

Defined cases: a NULL text has no words; a NULL source is a source of its own,
the last one; NULL ids and repeated rows are documents like others; empty
documents and sources without words take nothing; an empty table gives no
rows; extra columns are ignored (``mix_sizes``) or kept (``mixed_documents``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietude.llm.common import fresh_name, quoted, stored

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]*"
MAX_SOURCES = 100_000
CHUNK_DOCS = 4096


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, cap: float) -> list[float]:
    """Words per source: ``share`` of all, dealt by weight, none above ``cap``
    times its size; what is above goes to the others by weight."""
    out = [0.0] * len(sizes)
    free = {i for i, s in enumerate(sizes) if s > 0}
    left = share * sum(sizes)
    while free:
        weight = sum(weights[i] for i in sorted(free))
        full = {i for i in free if left * weights[i] / weight > cap * sizes[i]}
        if not full:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in sorted(full):
            out[i] = cap * sizes[i]
            left -= out[i]
        free -= full
    return out


@dataclass(frozen=True)
class Plan:
    """What the tasks need to draw: per source blocks and slots to give."""

    block_words: int
    blocks: tuple[int, ...]
    slots: tuple[int, ...]
    shard_slots: int
    seed: int

    @property
    def shards(self) -> int:
        return -(-sum(self.slots) // self.shard_slots)


def _split(quota: np.ndarray, left_slots: int, rng: np.random.Generator) -> np.ndarray:
    """Multinomial counts for ``left_slots`` slots, none above its quota."""
    counts = np.minimum(rng.multinomial(left_slots, quota / quota.sum()), quota)
    short = left_slots - int(counts.sum())
    for i in np.argsort(-(quota - counts), kind="stable"):
        if not short:
            break
        more = min(short, int(quota[i] - counts[i]))
        counts[i] += more
        short -= more
    return counts


def shard_counts(plan: Plan, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in a shard, and the index of the first of them."""
    quota, first = np.array(plan.slots, np.int64), np.zeros(len(plan.slots), np.int64)
    lo, hi = 0, plan.shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _split(quota, (mid - lo) * plan.shard_slots, np.random.default_rng([plan.seed, lo, hi]))
        if shard < mid:
            quota, hi = left, mid
        else:
            quota, first, lo = quota - left, first + left, mid
    return quota, first


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n): a four-round Feistel network on
    the next even number of bits, walked until the value is below n."""
    half = np.uint64(max(1, -(-int(n - 1).bit_length() // 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.default_rng(key).integers(1, 1 << 63, 4, dtype=np.uint64)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def shard_slots(plan: Plan, shard: int) -> pd.DataFrame:
    """The slots of one output shard: source, block index and pass of each."""
    counts, first = shard_counts(plan, shard)
    order = np.random.default_rng([plan.seed, 1, shard]).permutation(int(counts.sum()))
    source = np.repeat(np.arange(len(counts)), counts)
    index = np.concatenate([np.arange(f, f + c) for f, c in zip(first, counts)])
    blocks = np.array(plan.blocks, np.int64)[source]
    turn = index // blocks
    block = np.empty(len(index), np.int64)
    for s, p in {*zip(source.tolist(), turn.tolist())}:
        here = (source == s) & (turn == p)
        block[here] = permuted(index[here] % blocks[here][0], plan.blocks[s],
                               (plan.seed * 1_000_003 + s) * 1_000_003 + p)
    return pd.DataFrame({"shard": shard, "slot": order, "src": source, "block": block, "pass": turn})


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _streams(docs: DataFrame, id_col: str, source_col: str, text_col: str, weights: Sequence[float],
             share: float, cap: float, seed: int, block_words: int | None, shard_slots_: int, size_col: str = ""):
    """Documents with their place in their source's stream, and the plan.
    ``size_col`` is their word count where they are a stored table with one. Added columns: size, src, start, source_size, target."""
    names = {n: fresh_name(docs, n) for n in ("size", "src", "start", "source_size", "target", "chunk", "order", "before")}
    size, src, start, chunk, order, before = (names[n] for n in ("size", "src", "start", "chunk", "order", "before"))
    sized = (docs.withColumn(size, F.col(size_col) if size_col else word_count(quoted(text_col)))
             .withColumn(order, F.xxhash64(quoted(id_col))))
    small = sized.select(quoted(source_col).alias("source"), F.col(size).alias("size"), F.col(order).alias("ord"))
    small = small if size_col else stored(small, "sizes")
    sums = small.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sums.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r.size for r in sums]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sums))], share, cap)
    if block_words is None:
        block_words = min(1024, max(16, min([s for s in sizes if s] or [1]) // 256))
    blocks = tuple(-(-s // block_words) for s in sizes)
    slots = tuple(min(int(cap * b), round(b * t / s)) if s else 0 for b, t, s in zip(blocks, goal, sizes))
    plan = Plan(block_words, blocks, slots, shard_slots_, seed)
    spark = docs.sparkSession
    table = spark.createDataFrame([(i, r.source, r.size, goal[i]) for i, r in enumerate(sums)],
                                  "s_src int, s_source string, s_size long, s_target double")
    # Place in the stream: sums of bounded chunks first, then within a chunk.
    chunks = max(1, -(-sum(r.n for r in sums) // CHUNK_DOCS))
    per_chunk = (small.groupBy("source", F.pmod(F.col("ord"), F.lit(chunks)).alias("c_chunk")).agg(F.sum("size").alias("c_size"))
                 .selectExpr("source AS c_source", "c_chunk",
                             "sum(c_size) OVER (PARTITION BY source ORDER BY c_chunk) - c_size AS c_before"))
    placed = (sized.withColumn(chunk, F.pmod(F.col(order), F.lit(chunks)))
              .join(per_chunk, quoted(source_col).eqNullSafe(F.col("c_source")) & (F.col(chunk) == F.col("c_chunk")))
              .join(F.broadcast(table), quoted(source_col).eqNullSafe(F.col("s_source"))))
    id_sql = "`" + id_col.replace("`", "``") + "`"
    placed = placed.withColumn(start, F.expr(
        f"c_before + sum({size}) OVER (PARTITION BY c_source, c_chunk ORDER BY {order}, {id_sql}, {size} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - {size}"))
    placed = placed.select(*[quoted(c) for c in docs.columns], size, F.col("s_src").alias(src), start,
                           F.col("s_size").alias(names["source_size"]), F.col("s_target").alias(names["target"]))
    return placed, plan, names


def draw(docs: DataFrame, plan: Plan) -> DataFrame:
    """All slots of the mix: shard, slot, src, block, pass."""
    spark = docs.sparkSession

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                yield shard_slots(plan, int(shard))

    parts = max(1, min(plan.shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return (spark.range(0, plan.shards, 1, parts)
            .mapInPandas(slots, "shard long, slot long, src int, block long, `pass` int"))


def _taken(rows: DataFrame, plan: Plan, src: str, start: str, size: str, *keep: str) -> DataFrame:
    """Rows with words, once per block they lie in and pass that takes it."""
    b = plan.block_words
    spans = rows.where(F.col(size) > 0).select(
        src, start, size, *keep,
        F.explode(F.expr(f"sequence({start} DIV {b}, ({start} + {size} - 1) DIV {b})")).alias("at"))
    drawn = draw(rows, plan).select(F.col("src").alias("d_src"), "block", "pass")
    # The draws come from a tiny range, but grow with the corpus: not to be broadcast.
    return (spans.join(drawn.hint("merge"), (F.col(src) == F.col("d_src")) & (F.col("at") == F.col("block")), "left")
            .withColumn("lo", F.expr(f"greatest({start}, at * {b})"))
            .withColumn("hi", F.expr(f"least({start} + {size}, (at + 1) * {b})")))


def mix_sizes(docs: DataFrame, weights: Sequence[float], share: float = 1.5, cap: float = 2.0,
              id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 7,
              block_words: int | None = None, slots_per_shard: int = 4096) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words)."""
    rows = stored(docs.select(quoted(id_col).alias("id"), quoted(source_col).cast("string").alias("source"),
                              word_count(quoted(text_col)).alias("words")), "sizes")
    placed, plan, n = _streams(rows, "id", "source", "", weights, share, cap, seed, block_words, slots_per_shard, "words")
    out = placed.select("id", n["src"], n["size"], n["start"], n["source_size"], n["target"])
    if not plan.shards:
        return out.selectExpr(f"id AS `{id_col}`", f"{n['size']} AS size", f"{n['source_size']} AS source_size",
                              f"{n['target']} AS target", "0L AS taken")
    hit = _taken(out, plan, n["src"], n["start"], n["size"], "id", n["source_size"], n["target"])
    taken = (hit.groupBy(n["src"], n["start"], "id", n["size"], n["source_size"], n["target"])
             .agg(F.sum(F.when(F.col("block").isNotNull(), F.col("hi") - F.col("lo")).otherwise(0)).alias("taken")))
    cols = ["id", n["size"], n["source_size"], n["target"], "taken"]
    none = out.where(F.col(n["size"]) == 0).withColumn("taken", F.lit(0).cast("long")).select(*cols)
    return taken.select(*cols).unionByName(none).toDF(id_col, "size", "source_size", "target", "taken")


def cut_words(text: Column, tokens: Column, spans: Column) -> Column:
    """The words of the given [lo, hi) ranges (sorted, disjoint), adjacent ranges with
    the text between them, others a blank apart; ranges of all words give the whole
    text. ``tokens``: the text's words, each with what follows it up to the next."""
    blanks = F.lit("".join(map(chr, (0x20, *range(0x09, 0x0E)))))

    def piece(span: Column, n: Column) -> Column:
        raw = F.array_join(F.slice(tokens, span["lo"].cast("int") + 1, (span["hi"] - span["lo"]).cast("int")), "")
        after = F.get(spans, n + 1)["lo"]
        return (F.when(after == span["hi"], raw)
                .otherwise(F.concat(F.rtrim(raw, blanks), F.when(after.isNull(), "").otherwise(" "))))

    taken = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return F.when(taken == F.size(tokens), text).otherwise(F.array_join(F.transform(spans, piece), ""))


def mixed_documents(docs: DataFrame, weights: Sequence[float], share: float = 1.5, cap: float = 2.0,
                    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 7,
                    block_words: int | None = None, slots_per_shard: int = 4096) -> DataFrame:
    """The mix as documents: for each document and pass that takes words of
    it, one row with the document's columns and the words taken."""
    row, words = fresh_name(docs, "row"), fresh_name(docs, "words")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(words, word_count(quoted(text_col))), "mix_rows")
    # The streams are made of sizes alone; whole documents meet their spans in one shuffle.
    thin = rows.select(*map(quoted, dict.fromkeys((id_col, source_col, row, words))))
    placed, plan, n = _streams(thin, id_col, source_col, "", weights, share, cap, seed, block_words, slots_per_shard, words)
    if not plan.shards:
        return docs.limit(0)
    keys = placed.select(n["src"], n["start"], n["size"], row)
    hit = _taken(keys, plan, n["src"], n["start"], n["size"], row).where("block IS NOT NULL")
    spans = (hit.groupBy(F.col(row).alias("t_row"), "pass")
             .agg(F.sort_array(F.collect_list(F.struct((F.col("lo") - F.col(n["start"])).alias("lo"),
                                                       (F.col("hi") - F.col(n["start"])).alias("hi")))).alias("t_spans")))
    # The texts are cut by Spark itself: whole documents beside the shuffle's and the
    # writer's buffers would be held twice more in batches for Python workers.
    tokens = fresh_name(docs, "tokens")
    joined = (rows.join(spans, F.col(row) == F.col("t_row"))
              .withColumn(tokens, F.regexp_extract_all(quoted(text_col), F.lit(f"{WORD}{BLANKS}"), F.lit(0))))
    text = cut_words(quoted(text_col), F.col(tokens), F.col("t_spans"))
    return joined.select(*[(text if c == text_col else quoted(c)).alias(c) for c in docs.columns])
