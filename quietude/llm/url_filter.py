"""URL allow/block rules in a trie over reversed host labels and path segments.

A rule is ``(action, "host/path")``. It fits its host and all subdomains when
the URL's path starts with the rule's path; of the rules that fit, the longest
wins: more host labels first, then the longer path. A URL that no rule fits
gets ``default``.

The trie has one level per host label (last label first), and under each host
node a second trie over the path's segments. A rule path that ends inside a
segment (``/en/1``) is kept at the node of its last whole segment together
with the unfinished rest. The trie is broadcast. It holds the rules only, so
its size is that of the rule list, which ``MAX_RULES`` bounds.

Defined cases: a NULL url, or one without ``://``, has an empty host and path
and no rule. An empty path starts with no rule path but the empty one. If two
rules name the same host and path, the blocking one wins. An empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.llm.common import LOWER, UPPER, quoted

MAX_RULES = 1_000_000

#: The rules of the registered query (fixed values).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]


class Node:
    """A trie node: children by label or segment, and what ends here."""

    __slots__ = ("children", "paths", "rests")

    def __init__(self) -> None:
        self.children: dict[str, Node] = {}
        self.paths: Node | None = None          # host nodes: the path trie
        self.rests: dict[str, tuple[str, str]] = {}  # path nodes: unfinished rest -> (rule, action)


def build_trie(rules: Iterable[tuple[str, str]]) -> Node:
    root = Node()
    for n, (action, rule) in enumerate(rules):
        if action not in ("allow", "block"):
            raise ValueError(f"unknown action {action!r}")
        if n >= MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules; raise MAX_RULES if the executors can hold them")
        host, slash, path = rule.partition("/")
        node = root
        for label in reversed(host.translate(_ASCII_LOWER).split(".")) if host else ():
            node = node.children.setdefault(label, Node())
        node.paths = node.paths or Node()
        node = node.paths
        *segments, rest = (slash + path).split("/")
        for segment in segments:
            node = node.children.setdefault(segment, Node())
        if node.rests.get(rest, ("", "allow"))[1] == "allow":
            node.rests[rest] = (rule, action)
    return root


_ASCII_LOWER = str.maketrans(UPPER, LOWER)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a URL; both empty without ``://``."""
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    cut = slash if slash >= 0 else end
    return rest[:cut].translate(_ASCII_LOWER), rest[cut:end]


def _longest_path(node: Node, path: str) -> tuple[str, str] | None:
    best, (first, *segments) = None, path.split("/")
    for segment in [first, *segments]:
        fits = [rest for rest in node.rests if segment.startswith(rest)]
        if fits:
            best = node.rests[max(fits, key=len)]
        if segment not in node.children:
            break
        node = node.children[segment]
    return best


def match(trie: Node, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits, as (rule, action)."""
    node, best = trie, None
    found = _longest_path(node.paths, path) if node.paths else None
    best = found or best
    for label in reversed(host.split(".")):
        node = node.children.get(label)
        if node is None:
            break
        found = _longest_path(node.paths, path) if node.paths else None
        best = found or best
    return best


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """id, host, path, rule (NULL if none fits) and verdict of every row."""
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))
    rows = pages.select(quoted(id_col).alias("id"), quoted(url_col).cast("string").alias("url"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [match(trie.value, h, p) if h or p else None for h, p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([h for h, _ in parts], pa.string()),
                 pa.array([p for _, p in parts], pa.string()),
                 pa.array([f and f[0] for f in found], pa.string()),
                 pa.array([f[1] if f else default for f in found], pa.string())],
                names=["id", "host", "path", "rule", "verdict"])

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(judged, f"id {kind}, host string, path string, rule string, verdict string")
            .select(F.col("id").alias(id_col), "host", "path", "rule", "verdict"))
