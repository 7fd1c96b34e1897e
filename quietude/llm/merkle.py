"""Merkle manifest of a dataset: a root that every row's content decides, a
proof for every row, and its check.

Rows are the leaves. The leaves of a group (a source), by ascending id, form a
tree of ``FANOUT``; the groups' roots, by group name, form one more tree of the
same kind, and its root stands for the whole table.

A tree is built by slot pivots: conditional aggregates put the children of a
parent into one column per slot. Joining the columns gives the text that the
parent hashes; leaving one's own column out gives one's siblings. ``BUNDLE``
levels are pivoted in each other after one shuffle (a bundle of 81 nodes to a
row), so a tree of n leaves takes log81(n) shuffles, each over a 81st of the
rows before. On the way down a bundle gets the path above it by a join on its
place and hands it on to its leaves; leaves themselves are never joined.

Places within a group come from a range sort over (group, id, leaf), not from
a window over the group: a source with a third of all rows is spread over as
many tasks as its share asks for. Rows that agree in everything are told apart
by their place in the input, so a hot row is spread as well.

Defined cases: NULL in a field is hashed as ``-``. A NULL group is a group of
its own, before the others; it is not the group named ``''``. NULL ids come
before the others. Rows with one id are ordered by their leaf; rows that agree
in all fields are leaves of their own, and which of them comes first changes
nothing. A group of one row has the leaf as its root, one group has its root
as the table's. An empty table has no rows and no root. Extra columns, also
ones named like the result's, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietude.llm.common import quoted, stored

FANOUT = 3
BUNDLE = 4  # levels that one shuffle builds
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_text(value: Column) -> Column:
    """What a field adds to its row's leaf: ``-``, or its UTF-8 length and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
           altered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """Columns id, grp, hash and other: the leaf of the row with the ``altered``
    fields instead of its own, where ``where`` holds; else NULL.

    ``grp`` orders as the groups do, with NULL as the empty text."""
    group = quoted(group_col).cast("string")
    other = F.lit(None).cast("string")
    if altered:
        other = leaf_hash([altered.get(f, quoted(f)) for f in fields])
        other = other if where is None else F.when(where, other)
    return docs.select(quoted(id_col).alias("id"),
                       F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("grp"),
                       leaf_hash([quoted(f) for f in fields]).alias("hash"), other.alias("other"))


def placed(nodes: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Add pos, a row's place within its ``grp`` by ``order``, from 0, and n,
    the group's rows; also give the largest group's rows.

    Rows are sorted by range; counts per (group, partition) then give what
    lies before. There are at most as many of them as partitions and groups."""
    by = [F.asc_nulls_first(c) for c in ("grp", *order, "dealt")]
    dealt = nodes.withColumn("dealt", F.monotonically_increasing_id())
    dealt = stored(dealt.repartitionByRange(*by).sortWithinPartitions(*by).drop("dealt")
                   .withColumn("at", F.monotonically_increasing_id()), name)
    dealt = dealt.selectExpr("*", "shiftright(at, 33) AS part")
    runs = dealt.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    runs = stored(runs.selectExpr("grp", "part", "first - sum(rows) OVER (PARTITION BY grp ORDER BY part) + rows AS shift",
                                  "sum(rows) OVER (PARTITION BY grp) AS n"), f"{name}-runs")
    return (dealt.join(runs, ["grp", "part"]).withColumn("pos", F.expr("at - shift")).drop("part", "shift", "at"),
            runs.agg(F.max("n")).first()[0] or 1)


def _pivot(nodes: DataFrame, level: int) -> DataFrame:
    """The parents of nodes (grp, bundle, pos, n, node): children by slot in c0, c1, ...

    In a group of at most FANOUT**level leaves one node is left on this level:
    it goes up as it is."""
    slots = [F.expr(f"max(CASE WHEN pos % {FANOUT} = {k} THEN node END) AS c{k}") for k in range(FANOUT)]
    up = nodes.groupBy("grp", "bundle", F.expr(f"pos div {FANOUT} AS pos")).agg(F.max("n").alias("n"), *slots)
    joined = ", ".join(f"coalesce(c{k}.hash, '')" for k in range(FANOUT))
    children = ", ".join(f"'c{k}', c{k}" for k in range(FANOUT))
    return up.selectExpr("grp", "bundle", "pos", "n", f"named_struct('hash', CASE WHEN n > {FANOUT ** level}L "
                         f"THEN sha2(concat({joined}), 256) ELSE c0.hash END, {children}) AS node")


def climb(nodes: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """Bundles (grp, pos, n, node) of each pass, leaves first; the last pass has
    one row per group, whose ``node.hash`` is the group's root.

    ``nodes``: grp, pos, n, node (a struct whose first field is ``hash``);
    ``largest``: the most rows that a group has."""
    passes: list[DataFrame] = []
    level = 0
    while not passes or FANOUT ** level < largest:
        rows = nodes.selectExpr("*", f"pos div {FANOUT ** BUNDLE} AS bundle").repartition("grp", "bundle")
        for k in range(BUNDLE):
            rows = _pivot(rows, level + k)
        passes.append(stored(rows.drop("bundle"), f"{name}{len(passes)}"))
        level += BUNDLE
        nodes = passes[-1].selectExpr("grp", "pos", "n", "named_struct('hash', node.hash) AS node")
    return passes


def _child(k: int, level: int) -> str:
    """The child in slot ``k``: its node and its siblings, the columns to its left
    and right (NULL where it goes up as it is)."""
    def side(slots) -> str:
        return "concat(" + ", ".join(["''", *[f"coalesce(node.c{j}.hash, '')" for j in slots]]) + ")"
    return (f"named_struct('slot', {k}, 'step', CASE WHEN n > {FANOUT ** level}L THEN named_struct('left', "
            f"{side(range(k))}, 'right', {side(range(k + 1, FANOUT))}) END, 'node', node.c{k})")


def descend(passes: list[DataFrame], starts: DataFrame) -> DataFrame:
    """One row per leaf: the leaf's node, its path (siblings on each level, the
    leaf's own first) and the further columns of ``starts``.

    ``starts``: grp and path, what lies above each group's root."""
    carried = [c for c in starts.columns if c not in ("grp", "path")]
    paths = starts.selectExpr("grp", "0L AS pos", "path", *carried)
    for p in reversed(range(len(passes))):
        rows = passes[p].join(paths, ["grp", "pos"])
        for k in reversed(range(BUNDLE)):
            children = ", ".join(_child(j, p * BUNDLE + k) for j in range(FANOUT))
            rows = (rows.selectExpr("grp", "pos", "n", "path", *carried, f"explode(array({children})) AS child")
                    .where("child.node IS NOT NULL")
                    .selectExpr("grp", f"pos * {FANOUT} + child.slot AS pos", "n",
                                "CASE WHEN child.step IS NULL THEN path ELSE concat(array(child.step), path) END AS path",
                                *carried, "child.node AS node"))
        paths = rows if p == 0 else rows.select("grp", "pos", "path", *carried)
    return paths


def manifest(rows: DataFrame) -> DataFrame:
    """Of rows as ``leaves`` gives them: id, grp, leaf, other, subroot, root and
    path, the siblings (left, right) from the leaf up to the root."""
    nodes, largest = placed(stored(rows, "leaves"), ["id", "hash"], "placed")
    trees = climb(nodes.select("grp", "pos", "n", F.struct("hash", "id", "other").alias("node")), largest, "tree")
    groups = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("node.hash").alias("hash"))
    groups, largest = placed(groups, ["name"], "groups")
    top = climb(groups.select("grp", "pos", "n", F.struct("hash", "name").alias("node")), largest, "top")
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    above = descend(top, top[-1].select("grp", nothing.alias("path"), F.col("node.hash").alias("root")))
    starts = above.select(F.col("node.name").alias("grp"), "path", F.col("node.hash").alias("subroot"), "root")
    return descend(trees, starts).select("node.id", "grp", F.col("node.hash").alias("leaf"), "node.other",
                                         "subroot", "root", "path")


def proof_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def verify(docs: DataFrame, altered: dict[str, Column], where: Column) -> DataFrame:
    """The manifest of ``docs`` against rows of which those ``where`` holds have
    the ``altered`` fields: one row per document with doc_id, leaf, subroot,
    root, proof_sha256, folded_root and verified."""
    m = manifest(leaves(docs, altered=altered, where=where))
    return (m.withColumn("folded_root", folded(F.coalesce("other", "leaf"), F.col("path")))
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                    F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


def even_crc(value: Column) -> Column:
    """Whether 2 divides the CRC-32 of a number's decimal text (NULL: no)."""
    return F.coalesce(F.crc32(value.cast("string").cast("binary")) % 2 == 0, F.lit(False))
