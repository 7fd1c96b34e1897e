"""Removal of long repeated byte strings (suffix-array dedup).

A byte goes when a string of ``length`` bytes that covers it starts anywhere else
too. The suffixes to compare are cut down first: of the ``ANCHOR``-byte grams in
each window of ``length`` bytes, the one with the smallest hash is the window's
anchor. Equal windows have equal anchors at equal places, so only windows whose
anchor occurs twice can repeat, and windows of one anchor form one problem.

For an anchor, its occurrences in the order of the bytes that follow them are an
interval of the suffix array, with the common prefixes of neighbours. Backward
extension by one byte at a time, breadth first, splits the interval by the
preceding byte (the Burrows-Wheeler column) into the intervals of the longer
strings; the order within each stays, and neighbours' common prefixes are range
minima of the former ones. After d steps an occurrence whose neighbour shares
``length - d`` following bytes is in a repeated window that starts d bytes before
the anchor. Expansion stops at the minimum length, and single occurrences drop
out. The intervals of many anchors are extended together in arrays.

Texts are compared once each: copies of a whole text are known by its digest.

Defined cases: a NULL text counts as empty; texts shorter than ``length`` lose
nothing. Copies of a text of at least ``length`` bytes lose all, repeated rows
included. NULL and repeated ids are rows like others; an empty table gives no
rows; extra columns are ignored. Very long texts are worked whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.llm.common import in_filter, key_filter, quoted, stored

ANCHOR = 50
GROUP_ROWS = 20_000

_RNG = np.random.default_rng(20240301)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0xD1342543DE82EF95)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MAX = np.uint64((1 << 64) - 1)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position on."""
    powers = np.cumprod(np.full(len(data), _BASE, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers)])
    h = (total[size:] - total[:-size]) * np.cumprod(np.full(len(data) - size + 1, _BASE_INVERSE, np.uint64))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, least and greatest offset) of a text's anchors: the
    windows that start at position minus offset have this anchor."""
    if len(data) < length:
        return (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 3
    h = gram_hashes(data, size)
    width = length - size + 1
    starts = len(h) - width + 1
    # Hashes with the position in the low bits: the leftmost of the smallest wins.
    low = np.uint64(max(1, int(len(h)).bit_length()))
    ranked = (h >> low << low) | np.arange(len(h), dtype=np.uint64)
    padded = np.full(-(-len(h) // width) * width, _MAX)
    padded[:len(h)] = ranked
    blocks = padded.reshape(-1, width)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    smallest = np.minimum(tail[:starts], head[width - 1:width - 1 + starts])
    at = (smallest & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:], [starts]]) - 1
    place = at[first]
    return h[place], place, place - last, place - first


def repeated_offsets(bucket: np.ndarray, right: list[bytes], left: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest offset of each occurrence's repeated windows (greatest
    is -1 where none is). Occurrences are sorted by (bucket, right); ``left`` is
    the preceding bytes, nearest first."""
    count = len(bucket)
    least, greatest = np.full(count, length, np.int64), np.full(count, -1, np.int64)
    if count < 2:
        return least, greatest
    right_len = np.array([len(b) for b in right])
    left_len = np.array([len(b) for b in left])
    follow = np.frombuffer(b"".join(b.ljust(length, b"\0") for b in right), np.uint8).reshape(count, length)
    depth = int(left_len.max())
    before = np.frombuffer(b"".join(b.ljust(depth, b"\0") for b in left), np.uint8).reshape(count, depth)
    # Common prefix of each occurrence with the one above it in its interval.
    differ = follow[1:] != follow[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    shared = np.minimum(shared, np.minimum(right_len[1:], right_len[:-1]))
    here = np.arange(count)
    new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    common = np.where(new, 0, np.concatenate([[0], shared]))
    interval = np.cumsum(new)
    for d in range(depth + 1):
        if not len(here):
            break
        # A single occurrence has no partner, and none in a longer string.
        alone = np.concatenate([interval[1:] != interval[:-1], [True]]) & np.concatenate([[True], interval[1:] != interval[:-1]])
        if alone.any():
            here, interval, common = here[~alone], interval[~alone], common[~alone]
        if not len(here):
            break
        above = common >= length - d
        hit = above.copy()
        hit[:-1] |= above[1:]
        rows = here[hit]
        least[rows] = np.minimum(least[rows], d)
        greatest[rows] = d
        if d == depth:
            break
        byte = np.where(left_len[here] > d, before[here, d].astype(np.int64), 256)
        key = interval * 257 + byte
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        moved = np.zeros(len(order), np.int64)
        inner = np.flatnonzero(~new)
        p, q = order[inner - 1], order[inner]
        moved[inner] = common[q]
        far = np.flatnonzero(q - p > 1)
        if len(far):
            cuts = np.stack([p[far] + 1, q[far] + 1], axis=1).ravel()
            moved[inner[far]] = np.minimum.reduceat(np.append(common, length), cuts)[::2]
        live = key % 257 != 256
        here, interval, common = here[order][live], np.cumsum(new)[live], moved[live]
    return least, greatest


def _rows_of(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column(0).cast(pa.binary()):
        yield text.as_py() or b""


def _digest(raw: bytes) -> bytes:
    return hashlib.md5(raw, usedforsecurity=False).digest()


def _anchored(length: int):
    """Anchor rows of each text: anchor, key, pos, lo, hi."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            columns, keys, counts = [[], [], [], []], [], []

            def done() -> pa.RecordBatch:
                hashes, *rest = (np.concatenate(c) for c in columns)
                owner = pa.array(np.repeat(np.arange(len(keys)), counts))
                return pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(keys, pa.binary()).take(owner),
                     *[pa.array(c.astype(np.int32)) for c in rest]], names=["anchor", "key", "pos", "lo", "hi"])

            for raw in _rows_of(batch):
                if len(raw) < length or (key := _digest(raw)) in seen:
                    continue
                seen.add(key)
                found = anchors(np.frombuffer(raw, np.uint8), length, ANCHOR)
                for column, values in zip(columns, found):
                    column.append(values)
                keys.append(key)
                counts.append(len(found[0]))
                if sum(counts) > 200_000:
                    yield done()
                    columns, keys, counts = [[], [], [], []], [], []
            if keys:
                yield done()
    return work


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (anchor, key, pos), those whose anchor occurs twice,
    each occurrence once. Holds one row."""
    held, told = None, False
    names = ["anchor", "key", "pos", "lo", "hi"]
    for batch in batches:
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if held is not None and row[0] == held[0]:
                if row[1:3] == held[1:3]:
                    continue
                if not told:
                    out.append(held)
                out.append(row)
                told = True
            else:
                told = False
            held = row
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()))], names=names)


def _wanted_texts(table):
    """(key, text) of the texts that the filter may hold, once a task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = table.value, set()
        for batch in batches:
            keys, texts = [], []
            for raw in _rows_of(batch):
                key = _digest(raw)
                if key not in seen and in_filter(key, wanted):
                    seen.add(key)
                    keys.append(key)
                    texts.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.binary())], names=["key", "body"])
    return work


def _contexts(length: int):
    """Per anchor occurrence the bytes its windows reach: anchor, right (from
    the anchor on), left (before it, nearest first), key, pos, lo, hi."""
    names = ["anchor", "right", "left", "key", "pos", "lo", "hi"]
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, raw, hits in zip(*(batch.column(c).to_pylist() for c in ("key", "body", "hits"))):
                for h in hits:
                    at, lo, hi = h["pos"], h["lo"], h["hi"]
                    out.append((h["anchor"], raw[at:at + length - lo], raw[at - hi:at][::-1], key, at, lo, hi))
                    if len(out) >= 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
    return work


def _spans(length: int):
    """Repeated spans (key, start, end) from contexts sorted by (anchor, right,
    left, lo, hi). Equal contexts are held once: their windows all repeat."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, right, left, own = [], [], [], []  # distinct contexts; own: (key, pos, lo, hi) of the first occurrence
        out: list[tuple[bytes, int, int]] = []
        held, twice = None, False

        def solve() -> None:
            least, greatest = repeated_offsets(np.array(bucket, np.int64), right, left, length)
            for (key, at, lo, hi), a, b in zip(own, least.tolist(), greatest.tolist()):
                a, b = max(a, lo), min(b, hi)
                if a <= b:
                    out.append((key, at - b, at - a + length))
            for x in (bucket, right, left, own):
                x.clear()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), (pa.binary(), pa.int32(), pa.int32()))], names=["key", "start", "end"])
            out.clear()
            return batch

        for batch in batches:
            for anchor, r, l, key, at, lo, hi in zip(*(batch.column(c).to_pylist() for c in
                                                       ("anchor", "right", "left", "key", "pos", "lo", "hi"))):
                same = held is not None and held[:3] == (anchor, r, l) and held[5:] == (lo, hi)
                if same:
                    if held[3:5] != (key, at):
                        out.append((key, at - hi, at - lo + length))
                        if not twice:
                            out.append((own[-1][0], own[-1][1] - hi, own[-1][1] - lo + length))
                        twice = True
                else:
                    if len(bucket) >= GROUP_ROWS and bucket[-1] != anchor:
                        solve()
                    bucket.append(anchor)
                    right.append(r)
                    left.append(l)
                    own.append((key, at, lo, hi))
                    twice = False
                held = (anchor, r, l, key, at, lo, hi)
            if len(out) > 50_000:
                yield flush()
        if bucket:
            solve()
        if out:
            yield flush()
    return work


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: key, merged spans, the hash of the bytes left."""
    for batch in batches:
        keys, spans, hashes = [], [], []
        for key, raw, found in zip(*(batch.column(c).to_pylist() for c in ("key", "body", "found"))):
            cuts = merged([(s["start"], s["end"]) for s in found])
            edges = [0, *[x for c in cuts for x in c], len(raw)]
            kept = hashlib.sha256()
            for lo, hi in zip(edges[::2], edges[1::2]):
                kept.update(raw[lo:hi])
            keys.append(key)
            spans.append([{"start": a, "end": b} for a, b in cuts])
            hashes.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(hashes, pa.string())], names=["key", "spans", "sha"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """id, n_bytes, spans (removed, [start, end) in bytes) and kept_sha256 of every row."""
    if length <= ANCHOR:
        raise ValueError(f"length must be over {ANCHOR}")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(quoted(text_col).cast("string"), F.lit("")).cast("binary")
    raw = docs.select(text.alias("text"))
    # Only what costs much and is read twice is stored; digests and their copies are cheap to make again.
    base = docs.select(quoted(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.unhex(F.md5(text)).alias("key"), F.sha2(text, 256).alias("sha"))
    rows = docs.count()
    hits = stored(raw.mapInArrow(_anchored(length), "anchor long, key binary, pos int, lo int, hi int")
                  .repartition(parts, "anchor").sortWithinPartitions("anchor", "key", "pos")
                  .mapInArrow(_repeated, "anchor long, key binary, pos int, lo int, hi int"), "anchors", None, True)

    def texts(keys: DataFrame) -> DataFrame:
        table = spark.sparkContext.broadcast(key_filter(keys, rows))
        return raw.mapInArrow(_wanted_texts(table), "key binary, body binary")

    per_text = hits.groupBy("key").agg(F.collect_list(F.struct("anchor", "pos", "lo", "hi")).alias("hits"))
    contexts = (texts(hits.select("key").distinct()).join(per_text.withColumnRenamed("key", "h_key"), F.col("key") == F.col("h_key"))
                .select("key", "body", "hits")
                .mapInArrow(_contexts(length), "anchor long, right binary, left binary, key binary, pos int, lo int, hi int"))
    order = ["anchor", "right", "left", "lo", "hi", "key", "pos"]
    spans = stored(contexts.repartition(parts, "anchor").sortWithinPartitions(*order)
                   .mapInArrow(_spans(length), "key binary, start int, end int"), "spans", None, True)
    copies = (base.where(f"n_bytes >= {length}").groupBy("key").count().where("count > 1")
              .selectExpr("key AS c_key"))
    found = (spans.join(copies, F.col("key") == F.col("c_key"), "left_anti")
             .groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("found")))
    cut = (texts(spans.select("key").distinct()).join(found.withColumnRenamed("key", "f_key"), F.col("key") == F.col("f_key"))
           .select("key", "body", "found")
           .mapInArrow(_cut, "key binary, spans array<struct<start:int,end:int>>, sha string")
           .dropDuplicates(["key"]).selectExpr("key AS s_key", "spans", "sha AS s_sha"))
    whole = "array(named_struct('start', 0, 'end', CAST(n_bytes AS INT)))"
    nothing = hashlib.sha256(b"").hexdigest()
    return (base.join(cut, F.col("key") == F.col("s_key"), "left").join(copies, F.col("key") == F.col("c_key"), "left")
            .select(F.col("id").alias(id_col), "n_bytes",
                    F.expr(f"CASE WHEN c_key IS NOT NULL THEN {whole} WHEN s_key IS NOT NULL THEN spans "
                           "ELSE array() END").alias("spans"),
                    F.expr(f"CASE WHEN c_key IS NOT NULL THEN '{nothing}' ELSE coalesce(s_sha, sha) END").alias("kept_sha256")))
