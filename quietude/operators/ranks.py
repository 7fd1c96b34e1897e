"""Exact percentiles in bounded state: rank selection by value buckets.

``percentile`` keeps every distinct value of a group in one buffer. Here a
group's values are never gathered. One scan gives the count and the range of
each group; each further scan counts the values of an interval in at most
``2 * BUCKETS`` buckets, picks the bucket that holds the wanted rank, and goes
on inside it with the bucket's own smallest and largest value. An interval of
one value ends the search. A round divides an interval by ``BUCKETS`` or more,
so any two distinct doubles are apart after five rounds; quantised readings
take one or two.

Between rounds only the intervals are kept: two for each percentile and group.
They are written to the checkpoint folder, so a lost executor repeats a round
at most. Rows are never shuffled in the search, only counts per bucket, unless
there are too many groups to broadcast their intervals.

Buckets are cut on the order code of a double, its IEEE bits as a signed
number: code(x) < code(y) exactly when x < y. NULL values take no part; NaN
counts as the largest value, as Spark sorts it. Of -0.0 and 0.0 either may
stand for the other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.functions.expr import E, dbl, q
from quietude.session import ensure_checkpoint_dir

BUCKETS = 1 << 14
_TOP = (1 << 63) - 1


def order_code_sql(x: str) -> str:
    """The IEEE bits of a DOUBLE with its sign: a BIGINT in the order of the values."""
    a = f"abs({x})"
    guess = f"CAST(floor(log2({a})) AS INT)"
    # log2 may miss by one next to a power of two; powers themselves are exact.
    e = f"({guess} - IF({a} < pow(2.0D, {guess}), 1, 0) + IF({a} >= pow(2.0D, {guess} + 1), 1, 0))"
    bits = f"(({e} + 1022) * {1 << 52}L + CAST({a} / pow(2.0D, {e}) * {float(1 << 52)!r}D AS BIGINT))"
    small = f"CAST({a} * {2.0 ** 537!r}D * {2.0 ** 537!r}D AS BIGINT)"
    size = f"CASE WHEN {a} < {2.0 ** -1022!r}D THEN {small} ELSE {bits} END"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN {_TOP}L WHEN {a} = double('infinity') "
            f"THEN IF({x} > 0, 1, -1) * {2047 << 52}L WHEN {x} < 0 THEN -({size}) ELSE {size} END")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a small table to the checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quietude-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, keys: list[str]):
    """Join condition: equal keys, NULL equal to NULL."""
    on = F.lit(True)
    for k in keys:
        on &= left[k].eqNullSafe(right[f"_k_{k}"])
    return on


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k_{k}" for k in keys})


def _narrowed(rows: DataFrame, open_: DataFrame, keys: list[str]) -> DataFrame:
    """One round: the wanted ranks (keys, lo, hi, ranks) of ``open_`` with the
    bucket of their interval that holds each."""
    side = _renamed(open_.select(*keys, "lo", "hi"), keys).selectExpr(
        "*", f"greatest(0, CAST(ceil(log2(CAST(hi AS DOUBLE) - CAST(lo AS DOUBLE) + 1)) AS INT) - {BUCKETS.bit_length() - 1}) AS shift")
    if keys:
        met = rows.join(side, _same(rows, side, keys) & E("_code BETWEEN lo AND hi"))
    else:  # two intervals for each percentile at most: constants of the plan
        own = ", ".join(f"named_struct('lo', CAST('{r.lo}' AS BIGINT), 'hi', CAST('{r.hi}' AS BIGINT), 'shift', {r.shift})"
                        for r in side.collect())
        met = rows.selectExpr("*", f"inline(filter(array({own}), i -> _code BETWEEN i.lo AND i.hi))")
    bucket = "shiftright(_code, shift) - shiftright(lo, shift)"
    counts = (met.groupBy(*keys, "lo", "hi", E(f"{bucket} AS bucket"))
              .agg(E("count(1) AS n"), E("min(_code) AS b_lo"), E("max(_code) AS b_hi"), E("min(_x) AS v_lo"), E("max(_x) AS v_hi")))
    over = f"(PARTITION BY {', '.join([*map(q, keys), 'lo', 'hi'])} ORDER BY bucket)"
    counts = _renamed(counts.selectExpr("*", f"sum(n) OVER {over} - n AS before"), keys)
    wanted = open_.select(*keys, F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.explode("ranks").alias("rank"))
    on = _same(wanted, counts, keys) & E("_lo = lo AND _hi = hi AND rank.at >= before AND rank.at < before + n")
    return wanted.join(counts, on).selectExpr(
        *map(q, keys), "b_lo AS lo", "b_hi AS hi", "v_lo", "v_hi",
        "named_struct('id', rank.id, 'at', rank.at - before) AS rank")


def with_percentiles(df: DataFrame, keys: list[str], x: str, aggs: list[str], probs: dict[str, float]) -> DataFrame:
    """Group ``df`` by ``keys`` (none: the whole table) with the SQL aggregates
    ``aggs`` and the exact interpolated percentiles ``probs`` (name: share) of
    ``x``; groups without a value get NULL.

    The position of share p in n sorted values is p * (n - 1); between two
    values it is interpolated, as ``percentile`` does."""
    x = f"CAST({x} AS DOUBLE)"
    code = order_code_sql(x)
    rows = df.filter(f"{x} IS NOT NULL").selectExpr(*map(q, keys), f"{x} AS _x", f"{code} AS _code")
    base = kept(df.groupBy(*keys).agg(
        *[E(a) for a in aggs], E(f"count({x}) AS _n"), E(f"min({code}) AS _lo"), E(f"max({code}) AS _hi"),
        E(f"min({x}) AS _v_lo"), E(f"max({x}) AS _v_hi")), "groups")
    spots = [(name, side, f"CAST({side}({dbl(p)} * (_n - 1)) AS BIGINT)") for name, p in probs.items() for side in ("floor", "ceil")]
    ranks = ", ".join(f"named_struct('id', {i}, 'at', {at})" for i, (_, _, at) in enumerate(spots))
    found = base.filter("_n > 0").selectExpr(*map(q, keys), "_lo AS lo", "_hi AS hi", "_v_lo AS v_lo", "_v_hi AS v_hi",
                                             f"explode(array({ranks})) AS rank")
    done, names = None, [*map(q, keys), "rank.id AS id", "v_lo AS v"]
    while True:
        ended = found.filter("lo = hi").selectExpr(*names)
        done = ended if done is None else done.unionByName(ended)
        open_ = found.filter("lo < hi")
        if not open_.take(1):
            break
        open_ = open_.groupBy(*keys, "lo", "hi").agg(F.collect_list("rank").alias("ranks"))
        found = kept(_narrowed(rows, open_, keys), "ranks")
    values = done.groupBy(*keys).agg(*[E(f"max(CASE WHEN id = {i} THEN v END) AS _r{i}") for i in range(len(spots))])
    if keys:
        side = _renamed(values, keys)
        out = base.join(side, _same(base, side, keys), "left")
    else:
        one = values.select(F.struct(*values.columns).alias("r")).scalar()
        out = base.withColumn("_r", one).selectExpr("*", "_r.*").drop("_r")
    exprs = []
    for i, (name, p) in enumerate(probs.items()):
        lo, hi, pos = f"_r{2 * i}", f"_r{2 * i + 1}", f"({dbl(p)} * (_n - 1))"
        exprs.append(f"CASE WHEN {lo} = {hi} THEN {lo} ELSE (ceil({pos}) - {pos}) * {lo} + ({pos} - floor({pos})) * {hi} END AS {q(name)}")
    columns = [c for c in base.columns if c not in ("_n", "_lo", "_hi", "_v_lo", "_v_hi")]
    return out.selectExpr(*map(q, columns), *exprs)
