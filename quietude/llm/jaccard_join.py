"""Similarity join of documents by the Jaccard coefficient of word n-grams.

A document's set holds the distinct n-word shingles of its text. Documents with
equal sets form one class; the join works on classes. Two classes link when
``100 * intersection >= percent * union``, which asks for an overlap of at
least ``ceil(percent * (a + b) / (100 + percent))`` of sets of a and b shingles.

The join is size-aware. Small sets (up to a boundary) enumerate their subsets of
exactly the size that a partner of each admissible size must share; equal
subsets meet in a bucket. Large sets scan inverted lists: every set posts its
rarest shingles, as many as a partner must hit at least one of, and meets the
sets in the lists of these shingles. The boundary minimises the number of
subsets plus list entries, estimated from the counts of set sizes and the
mean list length. Shingle frequencies, for the order and the estimate, come from
a hashed count table of fixed size over all documents.

Only connected components are asked for, so a bucket does not emit all its
pairs. First each member is verified against the bucket's hub, the member with
the fewest rare shingles. Then the pairs whose ends the hubs have not
connected are verified, so no link between components is lost. Sketches of the
sets (a parity bit for each of ``PARITY`` bins) rule out most of a bucket's pairs
before they are emitted, and histograms most others before whole texts are fetched
and compared. A bucket of more than ``BLOCK`` rows is dealt into blocks, and each
pair of blocks is a task's group of its own.

Nothing grows with the corpus on the driver or in a broadcast: the count table has
``CELLS`` counts, the filter of candidate classes at most 2**27 bits.

Defined cases: a NULL text counts as empty. A text with fewer words than a
shingle is one shingle of all its words; one without words has an empty set and
links with nothing. Repeated rows are documents of one class. NULL ids are no
component's smallest id unless all of its ids are NULL. Very long texts are
shingled whole. An empty table gives no rows; extra columns are ignored
(``link``) or kept (``keep_one``).
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.llm.arrow_text import text_runs
from quietude.llm.common import discard, fresh_name, held, key_filter, longs_in_filter, quoted, stored
from quietude.llm.exact_dedup import split_by_keys

CELLS = 1 << 20
CHUNK = 1 << 12
MAX_BOUNDARY = 40
BINS = 128
PARITY = 512
BLOCK = 1 << 14
SHORT = 64
RUN_BYTES = 1 << 17  # of text whose words are hashed together: the arrays of 8 bytes a letter stay small
POSTS = 1 << 16  # about as many bucket rows leave a task together
BATCH_BYTES = 1 << 22  # of texts go to a worker together

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = np.cumprod(np.full(RUN_BYTES, _BASE, np.uint64))
_INVERSES = np.cumprod(np.full(RUN_BYTES, _BASE_INVERSE, np.uint64))
_ALL = (1 << 64) - 1
_ORDER = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(known: np.ndarray, n: int) -> np.ndarray:
    """The first n powers of ``known[0]``, of which some are known."""
    return known[:n] if n <= len(known) else np.cumprod(np.full(n, known[0], np.uint64))


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values (sorting takes less than the hash table of ``np.unique``)."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a run."""
    empty = np.empty(0, np.uint64)
    if not len(data):
        return [empty] * (len(offsets) - 1)
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = offsets[1:-1][offsets[1:-1] < len(data)]
    first[inner] = word[inner]
    starts = np.flatnonzero(first)
    # A word ends before the next white space or the next text.
    stop = ~word
    stop[inner] = True
    stops = np.append(np.flatnonzero(stop), len(data))
    ends = stops[np.searchsorted(stops, starts, "right")]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_POWERS, len(data)))])
    hashes = mixed((total[ends] - total[starts]) * _powers(_INVERSES, len(data))[starts])
    cuts = np.searchsorted(starts, offsets).tolist()
    out = []
    grams = empty
    if len(hashes) >= words:
        grams = np.zeros(len(hashes) - words + 1, np.uint64)
        for i in range(words):
            grams += hashes[i:len(hashes) - words + 1 + i] * _ORDER[i]
        grams = mixed(grams)
    for lo, hi in zip(cuts, cuts[1:]):
        if hi - lo >= words:
            out.append(distinct(grams[lo:hi - words + 1]))
        elif hi > lo:
            short = (hashes[lo:hi] * _ORDER[:hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            out.append(mixed(np.array([short ^ _ORDER[-1]], np.uint64)))
        else:
            out.append(empty)
    return out


def signature(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


@dataclass(frozen=True)
class Threshold:
    """Link condition ``100 * i >= percent * u`` in whole numbers."""

    percent: int

    def overlap(self, a: int, b: int) -> int:
        return -(-self.percent * (a + b) // (100 + self.percent))

    def smallest(self, n: int) -> int:
        return -(-self.percent * n // 100)

    def largest(self, n: int) -> int:
        return 100 * n // self.percent

    def probe(self, n: int) -> int:
        """Rarest shingles of which any partner not larger has one in its list."""
        return n - self.smallest(n) + 1

    def index(self, n: int) -> int:
        """Rarest shingles that a partner not smaller must find one of."""
        return n - self.overlap(n, n) + 1

    def subset_sizes(self, n: int, boundary: int) -> list[tuple[int, int, int]]:
        """(smaller, larger, overlap) of pairs of unequal sets a set of n can be in."""
        out = []
        for m in range(self.smallest(n), min(self.largest(n), boundary) + 1):
            a, b = min(n, m), max(n, m)
            c = self.overlap(a, b)
            if m >= 1 and not (a == b and c == a):  # equal sets are one class already
                out.append((a, b, c))
        return out

    def subsets(self, n: int, boundary: int) -> int:
        return sum(math.comb(n, c) for _, _, c in self.subset_sizes(n, boundary))


def choose_boundary(sizes: dict[int, int], mean_list: float, threshold: Threshold) -> int:
    """The largest size that enumerates subsets, by least estimated cost."""
    def cost(boundary: int) -> float:
        return sum(k * (threshold.subsets(n, boundary) if n <= boundary else threshold.probe(n) * (1 + mean_list))
                   for n, k in sizes.items() if n <= MAX_BOUNDARY)
    return min(range(MAX_BOUNDARY + 1), key=lambda b: (cost(b), b))


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(20)).astype(np.int64) & (CELLS - 1)


def _each_set(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingles) of a batch whose column 1 is the text."""
    for lo, _, data, offsets in text_runs(batch.column(1), RUN_BYTES):
        for n, s in enumerate(shingle_sets(data, offsets, words)):
            yield lo + n, s


def _surveyed(words: int):
    """Rows (id, n, node, text_key) of documents, and the task's shingle counts in chunks."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(CELLS, np.uint32), set()
        cells, held = [], 0

        def count() -> None:
            counts[:] += np.bincount(np.concatenate(cells), minlength=CELLS).astype(np.uint32)
            cells.clear()

        names = ["id", "n", "node", "text_key", "chunk", "counts"]
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            n, nodes = [], []
            for _, s in _each_set(batch, words):
                n.append(len(s))
                nodes.append(signature(s))
                if nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    cells.append(_cells(s))
                    held += len(s)
                    if held >= CELLS >> 1:
                        count()
                        held = 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), batch.column(2),
                                              pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=names)
        if cells:
            count()
        if kind is not None:
            parts = [zlib.compress(counts[lo:lo + CHUNK].tobytes(), 1) for lo in range(0, CELLS, CHUNK)]
            k = len(parts)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, kind), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64()),
                                              pa.array(range(k), pa.int32()), pa.array(parts, pa.binary())], names=names)
    return work


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the count chunks that came to this task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[chunk] = total.get(chunk, np.zeros(CHUNK, np.uint64)) + np.frombuffer(zlib.decompress(counts), np.uint32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()),
         pa.array([np.minimum(c, 0xFFFFFFFF).astype(np.uint32).tobytes() for c in total.values()], pa.binary())],
        names=["chunk", "counts"])


# What a posting says beside key and node, as wide as the sizes of sets ask for: the
# number of rare shingles, the size n and pos (the place in the order of rarity, -1
# for a subset). Rows sort by it in this order.
_INFO = ["rare", "n", "pos"]
_INFO_SCHEMA = "rare long, n long, pos long"


def _longs(rows: list) -> np.ndarray:
    return np.array(rows, np.int64)


def _posted(words: int, threshold: Threshold, boundary: int, table, noise: float):
    """Bucket rows of each class: key, node, and the number of its rare shingles,
    its size and the key's place (see ``_INFO``)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = table.value, set()
        key, at, info, nodes = [], [], [], []  # info: (rare, n, pos) of each row

        def put(keys: np.ndarray, n: int, places: np.ndarray, few: int) -> int:
            key.append(keys)
            at.append(np.full(len(keys), len(nodes) - 1))
            info.append(np.stack([np.full(len(keys), few, np.int64), np.full(len(keys), n, np.int64), places.astype(np.int64)]))
            return len(keys)

        def rows() -> pa.RecordBatch:
            owner = pa.array(np.concatenate(at), pa.int64())
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(key).view(np.int64)), pa.array(nodes, pa.binary()).take(owner),
                 *map(pa.array, np.concatenate(info, axis=1))], names=["key", "node", *_INFO])
            for held in (key, at, info, nodes):
                held.clear()
            return out

        posts = 0
        for batch in batches:
            for _, s in _each_set(batch, words):
                n = len(s)
                if not n or (node := signature(s)) in seen:
                    continue
                seen.add(node)
                if threshold.largest(n) == n and threshold.overlap(n, n) == n and threshold.smallest(n) == n:
                    continue  # only an equal set can link
                nodes.append(node)
                freq = counts[_cells(s)]
                few = int((freq <= noise).sum())
                if n <= boundary:
                    spread = mixed(s)
                    whole = spread.sum(dtype=np.uint64)
                    for a, b, c in threshold.subset_sizes(n, boundary):
                        gone = np.array(list(combinations(range(n), n - c)), np.int64).reshape(math.comb(n, c), n - c)
                        keys = whole - spread[gone].sum(axis=1, dtype=np.uint64)
                        posts += put(mixed(keys + np.uint64(((a << 32) + b) * int(_ORDER[0]) & _ALL)), n, np.full(len(keys), -1), few)
                    length = threshold.index(n) if threshold.largest(n) > boundary else 0
                else:
                    length = threshold.probe(n)
                if length:
                    first = np.lexsort((s, freq))[:length]
                    posts += put(s[first], n, np.arange(length), few)
                if posts >= POSTS:
                    yield rows()
                    posts = 0
        if key:
            yield rows()
    return work


def _may_link(t: Threshold, boundary: int, n1, pos1, n2, pos2) -> np.ndarray:
    """Whether pairs that share a key can link with that key as the first they share."""
    a, b = np.minimum(n1, n2), np.maximum(n1, n2)
    pos_a, pos_b = np.where(n1 <= n2, pos1, pos2), np.where(n1 <= n2, pos2, pos1)
    need = -(-t.percent * (a + b) // (100 + t.percent))
    subset = (pos1 < 0) & (pos2 < 0)
    listed = (pos1 >= 0) & (pos2 >= 0) & (b > boundary) & (np.minimum(a - pos_a, b - pos_b) >= need)
    return (100 * a >= t.percent * b) & (subset | listed)


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in which each run of equal keys is whole, and the starts of the runs
    and the end, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None

    def joined() -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(held).combine_chunks()
        names = np.stack([rows.column(c).to_numpy() for c in keys], axis=1)
        return rows, np.concatenate([[0], np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1, [len(names)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([np.asarray(batch.column(batch.schema.get_field_index(c))) for c in keys], axis=1)
        cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
        cut = int(cuts[-1]) if len(cuts) else 0
        if cut:
            held.append(batch.slice(0, cut))
        if held and (cut or last != tuple(names[0])):
            yield joined()
            held = []
        held.append(batch.slice(cut))
        last = tuple(names[-1])
    if held:
        yield joined()


def _shared(t: Threshold, boundary: int):
    """Of bucket rows (key, rare, n, pos, node) sorted in this order, those of buckets with two
    classes or more, with the hub and whether the pair with it may link (never a
    hub with itself). Of a bucket that goes on in the next batch, holds two rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the open bucket's hub and the last row
        told = False  # whether that hub has been given
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, lead = pa.concat_batches([*held, batch]), len(held)
            key, rare, n, pos = (rows.column(c).to_numpy() for c in ("key", *_INFO))
            node = np.frombuffer(b"".join(rows.column("node").to_pylist()), np.int64).reshape(rows.num_rows, -1)
            whole = np.column_stack([key, rare, n, pos, node])
            first = np.append(True, key[1:] != key[:-1])
            again = np.append(False, (whole[1:] == whole[:-1]).all(axis=1))
            hub = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
            own = (node == node[hub]).all(axis=1)
            out = np.flatnonzero(~again & ~own)
            out = out[out >= lead]
            hubs = np.unique(hub[out])
            hubs = hubs[1:] if lead and told and len(hubs) and hubs[0] == 0 else hubs
            told = bool(hub[-1] in hubs or (told and lead and hub[-1] == 0))
            held = [rows.take(pa.array([k])) for k in (hub[-1], len(key) - 1)]
            out = np.sort(np.concatenate([hubs, out]))
            if len(out):
                at = hub[out]
                may = _may_link(t, boundary, n[out], pos[out], n[at], pos[at]) & ~own[out]
                given = rows.take(pa.array(out))
                yield pa.RecordBatch.from_arrays(
                    [*(given.column(c) for c in ("key", "node", *_INFO)), rows.column("node").take(pa.array(at)), pa.array(may)],
                    names=["key", "node", *_INFO, "hub", "may"])
    return work


def _unconnected(t: Threshold, boundary: int, block: int = 128):
    """Pairs (x, y) of a group of bucket rows that may link and are in different
    components. Of rows of two blocks, only those of different blocks are paired.
    Groups of at most ``SHORT`` rows are worked together, others by themselves, ``block``
    rows with 4 * ``block`` at a time: some twenty arrays have a value of each such pair."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in _whole_runs(batches, ["key", "lo", "hi"]):
            root = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
            n, pos, part, low, high = (rows.column(c).to_numpy().astype(np.int64) for c in ("n", "pos", "block", "lo", "hi"))
            node = rows.column("node")
            sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(len(n), -1)

            def near(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                keep = (root[i] != root[j]) & ((low[i] == high[i]) | (part[i] != part[j])) & _may_link(t, boundary, n[i], pos[i], n[j], pos[j])
                i, j = i[keep], j[keep]
                keep = _near(t, n[i], n[j], sketch, i, j)
                return i[keep], j[keep]

            def named(i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
                pairs = sorted({(min(a, b), max(a, b)) for a, b in zip(node.take(i).to_pylist(), node.take(j).to_pylist())})
                return pa.RecordBatch.from_arrays([pa.array([p[c] for p in pairs], pa.binary()) for c in (0, 1)], names=["x", "y"])

            lengths = np.diff(cuts)
            mixed_roots = np.logical_or.reduceat(root != np.repeat(root[cuts[:-1]], lengths), cuts[:-1])
            # Short groups: each row with the row d places after it.
            left = np.repeat(np.where(mixed_roots & (lengths <= SHORT), cuts[1:], 0), lengths)
            first, d, found = np.arange(len(n)), 1, []
            while len(first := first[first + d < left[first]]):
                found.append(near(first, first + d))
                d += 1
            if found:
                yield named(*(np.concatenate(c) for c in zip(*found)))
            # Others in the order of size: the partners of a row are near it.
            for g in np.flatnonzero(mixed_roots & (lengths > SHORT)).tolist():
                order = cuts[g] + np.argsort(n[cuts[g]:cuts[g + 1]], kind="stable")
                size = n[order]
                for lo in range(0, len(order), block):
                    hi = min(lo + block, len(order))
                    end = int(np.searchsorted(size, t.largest(int(size[hi - 1])), "right"))
                    for at in range(lo, end, 4 * block):
                        i, j = np.meshgrid(np.arange(lo, hi), np.arange(at, min(at + 4 * block, end)), indexing="ij")
                        after = i < j
                        i, j = near(order[i[after]], order[j[after]])
                        if len(i):
                            yield named(i, j)
    return work


def _near(t: Threshold, n1: np.ndarray, n2: np.ndarray, sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the sketches i and j differ in no more bits than linked sets of these
    sizes differ in shingles."""
    need = -(-t.percent * (n1 + n2) // (100 + t.percent))
    apart = np.zeros(len(i), np.int64)
    for word in sketch.T:
        apart += np.bitwise_count(word[i] ^ word[j])
    return apart <= n1 + n2 - 2 * need


def _sketch(shingles: np.ndarray) -> bytes:
    """The parity of a set's shingles in each bin. A shingle that one of two sets has
    alone changes one bit, so sketches differ in at most as many bits as sets in shingles."""
    bins = np.bincount((shingles >> np.uint64(7) & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY)
    return np.packbits((bins & 1).astype(np.uint8)).tobytes()


def _histogram(shingles: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles by their low bits. The L1 distance of two
    histograms is at most the size of the sets' symmetric difference."""
    return np.bincount((shingles & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS).astype(np.uint32)


def _wanted(words: int, table, bins: bool):
    """(node, content, sketch) of the texts whose key the filter may hold: their histogram
    and sketch, or their text, compressed (sets of hashes are larger and don't compress).
    Shingles are made of these texts alone."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, seen = table.value, set()
        for batch in batches:
            batch = batch.filter(pa.array(longs_in_filter(batch.column(0).to_numpy(), wanted), pa.bool_()))
            nodes, out, sketches = [], [], []
            for row, s in _each_set(batch, words):
                if len(s) and (node := signature(s)) not in seen:
                    seen.add(node)
                    nodes.append(node)
                    out.append(_histogram(s).tobytes() if bins else zlib.compress(batch.column(1)[row].as_py().encode(), 1))
                    sketches.append(_sketch(s) if bins else None)
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (nodes, out, sketches)],
                                                 names=["node", "content", "sketch"])
    return work


def _set_of(packed: bytes, words: int) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(packed), np.uint8)
    return shingle_sets(raw, np.array([0, len(raw)]), words)[0]


def _plausible(t: Threshold):
    """The pairs (x, y) whose histograms allow the overlap that a link needs."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, BINS).astype(np.int64) for c in (2, 3))
            a, b = x.sum(axis=1), y.sum(axis=1)
            need = -(-t.percent * (a + b) // (100 + t.percent))
            keep = np.abs(x - y).sum(axis=1) <= a + b - 2 * need
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(keep))
    return work


def _verified(percent: int, words: int):
    """The pairs (x, y) that link, from their texts; sorted by y, so its set is
    made once for a run of pairs."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, y = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # texts are unpacked a few rows at a time
                part, keep = batch.slice(lo, 256), []
                for a, name, b in zip(*(part.column(c).to_pylist() for c in (2, 1, 3))):
                    if name != last:
                        last, y = name, _set_of(b, words)
                    x = _set_of(a, words)
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))
    return work


def only_stars(links: DataFrame) -> bool:
    """Whether every u of the links (u, v) has one link and no v is a u: each
    component is then its smallest node with the others around it."""
    ends = (links.selectExpr("u AS n", "1L AS up", "0 AS down")
            .unionByName(links.selectExpr("v AS n", "0L AS up", "1 AS down")))
    seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not seen.where("up > 1 OR (up = 1 AND down = 1)").count()


def components(edges: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """(node, root) of every node with an edge; root is the component's smallest
    node. Alternating large and small stars until only stars are left."""
    links = held(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u != v").distinct())
    while not only_stars(links):
        # Large star: the larger neighbours of a node go to its smallest one.
        both = links.unionByName(links.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).selectExpr("u AS w", "least(u, low) AS low")
        large = both.join(low, F.col("u") == F.col("w")).where("v > u").selectExpr("v AS u", "low AS v").where("u != v").distinct()
        large = held(large)
        # Small star: a node and its smaller neighbours go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "w")
        small = (large.join(low, F.col("u") == F.col("w")).where("v != low").selectExpr("v AS u", "low AS v")
                 .unionByName(low.selectExpr("w AS u", "low AS v")).distinct())
        links = held(small)
    return held(links.selectExpr("u AS node", "v AS root").unionByName(
        links.select("v").distinct().selectExpr("v AS node", "v AS root")))


def classes(docs: DataFrame, id_col: str, text_col: str, percent: int = 90, words: int = 3) -> DataFrame:
    """id, n (set size), node (class) and root (component of classes) of every row."""
    spark, t = docs.sparkSession, Threshold(percent)
    rows = (docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
            .withColumn("text_key", F.xxhash64("text")))
    kind = rows.schema["id"].dataType.simpleString()
    survey = stored(rows.mapInArrow(_surveyed(words), f"id {kind}, n long, node binary, text_key long, chunk int, counts binary"), "survey", BATCH_BYTES)
    found = stored(survey.where("chunk IS NULL").select("id", "n", "node", "text_key"), "found")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = (survey.where("chunk IS NOT NULL").select("chunk", "counts").repartition(parts, "chunk")
              .mapInArrow(_summed, "chunk int, counts binary").collect())
    discard(survey)
    counts = np.zeros(CELLS, np.uint32)
    for chunk, part in chunks:
        counts[chunk * CHUNK:(chunk + 1) * CHUNK] = np.frombuffer(part, np.uint32)
    weight = counts.astype(float)
    mean = weight.mean()
    noise = mean + 4 * mean ** 0.5 + 2
    mean_list = max(0.0, (weight ** 2).sum() / max(1.0, weight.sum()) - mean - 1)
    sizes = {r["n"]: r["count"] for r in found.where(f"n BETWEEN 1 AND {MAX_BOUNDARY}").groupBy("n").count().collect()}
    boundary = choose_boundary(sizes, mean_list, t)

    table = spark.sparkContext.broadcast(counts)
    posts = rows.select("id", "text").mapInArrow(_posted(words, t, boundary, table, noise), f"key long, node binary, {_INFO_SCHEMA}")
    shared = stored(posts.repartition(parts, "key").sortWithinPartitions("key", *_INFO, "node")
                    .mapInArrow(_shared(t, boundary), f"key long, node binary, {_INFO_SCHEMA}, hub binary, may boolean"),
                    "buckets", BATCH_BYTES)

    texts = held(found.where("n > 0").groupBy("node").agg(F.min("text_key").alias("text_key")))
    many = texts.count()

    def contents(nodes: DataFrame, bins: bool) -> DataFrame:
        """Histograms or texts of classes, from one text of each, by a filter of
        bounded size; classes not asked for may come too. A class of many copies
        may be there once per input task."""
        chosen = texts.join(nodes.withColumnRenamed("node", "asked"), F.col("node") == F.col("asked"), "left_semi")
        wanted = spark.sparkContext.broadcast(key_filter(chosen.select("text_key"), many))
        return rows.select("text_key", "text").mapInArrow(_wanted(words, wanted, bins), "node binary, content binary, sketch binary")

    histograms = stored(contents(shared.select("node").distinct(), True).dropDuplicates(["node"]), "bins", BATCH_BYTES)

    def verify(pairs: DataFrame) -> DataFrame:
        """The pairs (x, y) that link: first by histograms, then by whole sets."""
        likely = held(
            pairs.join(histograms.selectExpr("node AS node_x", "content AS in_x"), F.col("x") == F.col("node_x"))
            .join(histograms.selectExpr("node AS node_y", "content AS in_y"), F.col("y") == F.col("node_y"))
            .select("x", "y", "in_x", "in_y").mapInArrow(_plausible(t), "x binary, y binary"), BATCH_BYTES)
        xs, ys = (likely.select(F.col(c).alias("node")).distinct() for c in ("x", "y"))
        hubs = contents(ys, False).dropDuplicates(["node"]).selectExpr("node AS node_y", "content AS in_y")
        joined = (likely.join(contents(xs, False).selectExpr("node AS node_x", "content AS in_x"), F.col("x") == F.col("node_x"))
                  .join(hubs, F.col("y") == F.col("node_y")).select("x", "y", "in_x", "in_y"))
        return held(joined.mapInArrow(_verified(percent, words), "x binary, y binary").distinct(), BATCH_BYTES)

    hub_pairs = stored(shared.where("may").selectExpr("node AS x", "hub AS y").distinct(), "hub_pairs")
    first = components(verify(hub_pairs))
    discard(hub_pairs)
    # Few classes have a link by now: the rows of others need no join.
    linked, alone, bitmaps = split_by_keys(shared.select("key", "node", "n", "pos"), "node", first)
    rooted = stored(linked.join(first.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"), "left")
                    .selectExpr("key", "node", "n", "pos", "coalesce(root, node) AS root")
                    .unionByName(alone.selectExpr("key", "node", "n", "pos", "node AS root")), "rooted")
    discard(shared, bitmaps)
    # Buckets inside one component are done; only the others come together again, in
    # groups of one bucket or of two of a large bucket's blocks.
    open_keys = stored(rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"),
                                                 F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
                       .where("least != most").selectExpr("key AS open_key", "blocks"), "open")
    again = (rooted.join(open_keys, F.col("key") == F.col("open_key"))
             .withColumn("block", F.expr("CAST(pmod(xxhash64(node, pos), blocks) AS INT)"))
             .withColumn("other", F.expr("explode(sequence(0, blocks - 1))"))
             .selectExpr("key", "node", "n", "pos", "root", "block", "least(block, other) AS lo", "greatest(block, other) AS hi")
             .join(histograms.selectExpr("node AS s_node", "sketch"), F.col("node") == F.col("s_node")).drop("s_node")
             .repartition(parts, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi"))
    pairs = held(again.mapInArrow(_unconnected(t, boundary), "x binary, y binary").distinct())
    discard(rooted, open_keys)
    rest = verify(pairs)
    roots = components(first.selectExpr("node AS x", "root AS y").unionByName(rest))
    discard(histograms)
    out = held(found.join(roots.withColumnRenamed("node", "r_node"), F.col("node") == F.col("r_node"), "left")
                 .selectExpr("id", "n", "node", "coalesce(root, node) AS root"))
    discard(found)
    return out


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90, words: int = 3) -> DataFrame:
    """id, n_shingles and component_id (the smallest id of its component) of every row."""
    rows = classes(docs, id_col, text_col, percent, words)
    groups = stored(rows.where("n > 0").groupBy("root").agg(F.min("id").alias("component_id"))
                    .withColumnRenamed("root", "g_root"), "groups")
    linked = rows.where("n > 0").join(groups, F.col("root") == F.col("g_root"))
    return (linked.select("id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(rows.where("n = 0").selectExpr("id", "n AS n_shingles", "id AS component_id"))
            .withColumnRenamed("id", id_col))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90, words: int = 3) -> DataFrame:
    """The rows of ``docs`` without the others of each component: the one with
    the smallest id stays. Documents without words all stay."""
    row = fresh_name(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = classes(rows, row, text_col, percent, words)
    named = found.where("n > 0").join(rows.select(F.col(row).alias("row"), quoted(id_col).alias("name")), F.col("id") == F.col("row"))
    firsts = (named.groupBy("root").agg(F.min(F.struct(F.col("name").isNull().alias("none"), "name", "row")).alias("first"))
              .selectExpr("first.row AS kept"))
    gone = held(found.where("n > 0").join(firsts, F.col("id") == F.col("kept"), "left_anti").select(F.col("id").alias(row)))
    # Whole documents are shuffled only if they may be among those that go.
    doubtful, sure, _ = split_by_keys(rows, row, gone)
    gone = gone.withColumnRenamed(row, "gone")
    return doubtful.join(gone, F.col(row) == F.col("gone"), "left_anti").unionByName(sure).drop(row)
