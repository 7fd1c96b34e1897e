"""The most frequent values without a shuffle of every value.

Counting all values to keep a few sends each task's distinct values through the
shuffle, nearly all of them in vain. Here a first scan counts the rows of each
hash cell: at most ``CELLS`` short rows leave a task, and a cell's count bounds
the count of every value in it. A second scan counts the values of the
``PROBE`` fullest cells exactly. The n-th largest of these counts is reached by
at least n values, so a value of a cell with fewer rows can't be among the first
n. If the fullest cell left out has fewer, the answer is there; else a third scan
counts the values of all cells with at least that many rows, which is exact for
any data. Where no value stands out, that is a plain count of most values.

The driver gets ``PROBE`` cell counts and the smallest of n counts; the cells of
the third scan, at most ``CELLS`` numbers, are broadcast.

Defined cases: NULL takes no part; ties go to the smaller value; with fewer than n
values all are returned, with none no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.functions.expr import E
from quietude.operators.ranks import kept

CELLS = 1 << 16
PROBE = 64


def top_values(rows: DataFrame, col: str, n: int, cells: int = CELLS, probe: int = PROBE) -> DataFrame:
    """(``col``, count) of the ``n`` most frequent values, most frequent first."""
    name = "`" + col.replace("`", "``") + "`"
    values = rows.filter(f"{name} IS NOT NULL").selectExpr(f"{name} AS _v", f"pmod(xxhash64({name}), {cells}) AS _cell")

    def first(some: DataFrame) -> DataFrame:
        return some.groupBy("_v").agg(E("count(1) AS count")).orderBy(F.desc("count"), "_v").limit(n)

    def named(found: DataFrame) -> DataFrame:
        return found.orderBy(F.desc("count"), "_v").selectExpr(f"_v AS {name}", "count")

    per_cell = kept(values.groupBy("_cell").agg(E("count(1) AS n")).coalesce(1), "cells")
    fullest = per_cell.orderBy(F.desc("n"), "_cell").limit(probe + 1).collect()
    found = kept(first(values.filter(F.col("_cell").isin([r["_cell"] for r in fullest[:probe]]))), "frequent")
    least = found.agg(E(f"IF(count(1) = {n}, min(count), 1) AS least")).first()["least"]
    if len(fullest) <= probe or fullest[probe]["n"] < least:
        return named(found)
    wide = per_cell.filter(F.col("n") >= least).select("_cell")
    return named(first(values.join(F.broadcast(wide), "_cell", "left_semi")))
