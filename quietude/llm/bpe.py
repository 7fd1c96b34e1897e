"""Byte-level BPE encoding and decoding with segment trees.

A text is cut at special tokens, then into words by the vocabulary's pattern.
Each word's adjacent symbol pairs are the leaves of a segment tree that holds
(rank, position); its root is the leftmost merge of the lowest rank. A merge
changes three leaves and their paths to the root, and the word is done when the
root holds no mergeable pair. The trees of many words are worked together, one
row of a matrix each, words of like length in one matrix; a few long words are
worked one by one, in a tree of plain numbers. Words seen before come from a
cache of bounded bytes, emptied when it is full and when the task ends.

Decoding joins the bytes of each id and reads them as UTF-8, with a replacement
character for what is not.

The vocabulary file is a parameter: a path that every executor can read (the
installed vocabularies are part of the Python environment), or its content.

Defined cases: a NULL text counts as empty and gives no ids; a NULL list of ids
decodes to an empty text; unknown ids raise. NULL and repeated document ids and
extra columns are carried or ignored as the caller selects.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quietude.llm.common import quoted

#: How byte-level vocabularies cut a text into words (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_BYTES = 1 << 26
ENTRY_BYTES = 200  # of the cache, for each word besides its letters
BATCH_CHARS = 1 << 20
MATRIX_CELLS = 1 << 20
FEW_WORDS = 32
_NONE = np.int64(1) << 62


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 bytes are themselves, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Merges as arrays, token bytes, special tokens and the word cache."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        if spec["model"]["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("not a byte-level BPE vocabulary")
        if spec["pre_tokenizer"]["add_prefix_space"] or spec["model"].get("ignore_merges"):
            raise ValueError("this vocabulary option is not supported")
        vocab: dict[str, int] = spec["model"]["vocab"]
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = {i: bytes(back[c] for c in token) for token, i in vocab.items()}
        pieces |= {i: token.encode() for token, i in self.special.items()}
        self.size = max(pieces) + 1
        lengths = np.array([len(pieces.get(i, b"")) for i in range(self.size)], np.int64)
        self.known = np.array([i in pieces for i in range(self.size)])
        self.piece_len, self.piece_at = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.piece_bytes = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(self.size)), np.uint8)
        self.byte_id = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order.astype(np.int64)
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.rank_by_key: dict[int, int] | None = None
        self.forget()

    def forget(self) -> None:
        """Empty the cache: word -> n, and n's ids at ``cache_at[n]``, ``cache_len[n]``
        of them, in ``cache_ids``. Special tokens are always known."""
        self.cache = {s: n for n, s in enumerate(self.special)}
        self.cache_ids = np.array(list(self.special.values()), np.int32)
        self.cache_len = np.ones(len(self.special), np.int64)
        self.cache_at = np.arange(len(self.special), dtype=np.int64)
        self.cache_bytes = 0

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair of symbols, ``_NONE`` where they don't merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.rank_of[at], _NONE)

    def merge_words(self, words: Sequence[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words of 1 to ``width`` bytes, a power of two."""
        count = len(words)
        lengths = np.array([len(w) for w in words])
        symbols = np.full((count, width + 1), -1, np.int64)  # the last column: no symbol
        inside = np.arange(width) < lengths[:, None]
        symbols[:, :width][inside] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        following = np.where(inside, np.minimum(np.arange(1, width + 1), np.where(
            np.arange(1, width + 1) < lengths[:, None], np.arange(1, width + 1), width)), width)
        before = np.tile(np.arange(-1, width), (count, 1))
        tree = np.full((count, 2 * width), _NONE, np.int64)
        place = np.arange(width, dtype=np.int64)
        ranks = self.ranks(symbols[:, :-1], symbols[:, 1:])
        tree[:, width:] = np.where(ranks < _NONE, ranks * width + place, _NONE)
        step = width // 2
        while step:
            tree[:, step:2 * step] = np.minimum(tree[:, 2 * step:4 * step:2], tree[:, 2 * step + 1:4 * step:2])
            step //= 2

        def update(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            node = leaf + width
            tree[rows, node] = value
            for _ in range(width.bit_length() - 1):
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] < _NONE) if width > 1 else np.empty(0, np.int64)
        while len(rows):
            rank, at = np.divmod(tree[rows, 1], width)
            gone = following[rows, at]
            after = following[rows, gone]
            symbols[rows, at] = self.merged[rank]
            symbols[rows, gone] = -1
            following[rows, at] = after
            real = after < width
            before[rows[real], after[real]] = at[real]
            update(rows, gone, np.full(len(rows), _NONE))
            found = self.ranks(symbols[rows, at], symbols[rows, after])
            update(rows, at, np.where(found < _NONE, found * width + at, _NONE))
            left = before[rows, at]
            has, r = left >= 0, rows
            found = self.ranks(symbols[r[has], left[has]], symbols[r[has], at[has]])
            update(r[has], left[has], np.where(found < _NONE, found * width + left[has], _NONE))
            rows = rows[tree[rows, 1] < _NONE]
        stays = symbols[:, :width] >= 0
        return symbols[:, :width][stays].astype(np.int32), stays.sum(axis=1)

    def merge_word(self, word: bytes, width: int) -> list[int]:
        """The ids of one word of at most ``width`` bytes, a power of two."""
        if self.rank_by_key is None:
            self.rank_by_key = dict(zip(self.keys.tolist(), self.rank_of.tolist()))
        ranks, size, none = self.rank_by_key, self.size, int(_NONE)
        symbols = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        count = len(symbols)
        following, before = list(range(1, count + 1)), list(range(-1, count - 1))
        tree = [none] * (2 * width)

        def leaf(at: int) -> int:
            after = following[at]
            rank = ranks.get(symbols[at] * size + symbols[after]) if after < count else None
            return none if rank is None else rank * width + at

        def update(at: int, value: int) -> None:
            node = at + width
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    return
                tree[node] = low

        tree[width:width + count] = map(leaf, range(count))
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            rank, at = divmod(tree[1], width)
            gone = following[at]
            symbols[at], symbols[gone] = int(self.merged[rank]), -1
            following[at] = following[gone]
            if following[at] < count:
                before[following[at]] = at
            update(gone, none)
            update(at, leaf(at))
            if before[at] >= 0:
                update(before[at], leaf(before[at]))
        return [i for i in symbols if i >= 0]

    def learn(self, words: Iterable[str]) -> None:
        """Put the ids of new words into the cache."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            raw = w.encode()
            by_width.setdefault(1 << (len(raw) - 1).bit_length(), []).append((w, raw))
        ids, lengths = [self.cache_ids], [self.cache_len]
        for width, group in by_width.items():
            size = max(1, MATRIX_CELLS // (2 * width))
            for lo in range(0, len(group), size):
                part = group[lo:lo + size]
                self.cache.update(zip((w for w, _ in part), range(len(self.cache), len(self.cache) + len(part))))
                if len(part) <= FEW_WORDS and width > FEW_WORDS:
                    found = [self.merge_word(raw, width) for _, raw in part]
                    more, counts = np.array(list(chain.from_iterable(found)), np.int32), np.array(list(map(len, found)))
                else:
                    more, counts = self.merge_words([raw for _, raw in part], width)
                ids.append(more)
                lengths.append(counts)
            self.cache_bytes += sum(len(raw) + ENTRY_BYTES for _, raw in group)
        self.cache_ids, self.cache_len = np.concatenate(ids), np.concatenate(lengths)
        self.cache_at = np.cumsum(self.cache_len) - self.cache_len

    def split(self, text: str) -> list[str]:
        """The words and special tokens of a text, in order."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.words.findall(text)
        out: list[str] = []
        for piece in self.cut.split(text):
            out += [piece] if piece in self.special else self.words.findall(piece)
        return out

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        parts = [self.split(t) for t in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        words = list(chain.from_iterable(parts))
        found = list(map(self.cache.get, words))
        if None in found:
            missing = {w for w, n in zip(words, found) if n is None}
            if self.cache_bytes + sum(map(len, missing)) + ENTRY_BYTES * len(missing) > CACHE_BYTES:
                self.forget()
                missing = set(words) - set(self.special)
            self.learn(missing)
            found = list(map(self.cache.get, words))
        index = np.array(found, np.int64)
        lengths = self.cache_len[index]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(int(ends[-1])) + np.repeat(self.cache_at[index] - ends[:-1], lengths)
        return self.cache_ids[place], np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of runs of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        lengths = self.piece_len[ids]
        ends = np.cumsum(lengths)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.piece_at[ids] - ends + lengths, lengths)
        raw = self.piece_bytes[place].tobytes()
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per Python worker and file."""
    with open(path, encoding="utf-8") as f:
        return Vocabulary(f.read())


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_CHARS`` characters together."""
    lo = size = 0
    for hi, text in enumerate(texts):
        if size and size + len(text) > BATCH_CHARS:
            yield lo, hi
            lo, size = hi, 0
        size += len(text)
    if lo < len(texts):
        yield lo, len(texts)


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))


def _worked(vocab: Vocabulary, batches: Iterator[pa.RecordBatch], work, names: list[str]) -> Iterator[pa.RecordBatch]:
    """A task's batches. The worker process outlives the task, its word cache does not:
    what runs in the process next has the memory."""
    try:
        for batch in batches:
            for lo, columns in work(vocab, batch.column(1)):
                here = [c.slice(lo, len(columns[0])) for n, c in enumerate(batch.columns) if n != 1]
                yield pa.RecordBatch.from_arrays([*here, *columns], names=names)
    finally:
        vocab.forget()
        pa.default_memory_pool().release_unused()


def _apply(docs: DataFrame, path: str, id_col: str, source_col: str, source_type: str, work, added: str,
           keep: Sequence[str] = ()) -> DataFrame:
    rows = docs.select(quoted(id_col).alias("id"), quoted(source_col).cast(source_type).alias("source"),
                       *[quoted(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    added_names = [f.split()[0] for f in added.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _worked(vocabulary(path), batches, work, [*kept_names, *added_names])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "source"]
    kept_names = [c for c in rows.columns if c != "source"]
    return rows.mapInArrow(run, ", ".join([*fields, added])).toDF(id_col, *keep, *added_names)


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of slices of a column; few rows at a time become strings."""
    for at in range(0, len(column), 256):
        texts = column.slice(at, 256).fill_null("").to_pylist()
        for lo, hi in _slices(texts):
            yield at + lo, texts[lo:hi]


def _encoded(vocab: Vocabulary, column: pa.Array):
    for lo, texts in _texts(column):
        yield lo, [_lists(*vocab.encode(texts))]


def _decoded(vocab: Vocabulary, column: pa.Array):
    for lo in range(0, len(column), 256):
        part = column.slice(lo, 256)
        counts = np.asarray(part.value_lengths().fill_null(0), np.int64)
        yield lo, [pa.array(vocab.decode(np.asarray(part.flatten(), np.int64), counts), pa.string())]


def _round_trip(vocab: Vocabulary, column: pa.Array):
    for lo, texts in _texts(column):
        ids, counts = vocab.encode(texts)
        yield lo, [_lists(ids, counts), pa.array(vocab.decode(ids, counts), pa.string())]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           keep: Sequence[str] = ()) -> DataFrame:
    """id, the ``keep`` columns and ids (array of int) of every row's text."""
    return _apply(docs, path, id_col, text_col, "string", _encoded, "ids array<int>", keep)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of every row's ids."""
    return _apply(encoded, path, id_col, ids_col, "array<int>", _decoded, "text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids and the text decoded from the ids, of every row, in one pass."""
    return _apply(docs, path, id_col, text_col, "string", _round_trip, "ids array<int>, decoded string")
