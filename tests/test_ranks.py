"""Exact percentiles by rank selection against numpy and Spark's own buffer."""

import math
import random
import struct

import numpy as np
import pytest

from quietude.operators import ranks, stats, trends
from quietude.sources import adapter
from quietude.sources.tables import table
from tests.conftest import SF_SMALL

PROBS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def exact(values, p):
    pos = p * (len(values) - 1)
    lo, hi = values[math.floor(pos)], values[math.ceil(pos)]
    return lo if lo == hi else (math.ceil(pos) - pos) * lo + (pos - math.floor(pos)) * hi


def found(spark, rows, keys=("k",)):
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    out = ranks.with_percentiles(df, list(keys), "x", ["count(1) AS n"], PROBS).collect()
    return {r["k"] if keys else None: r for r in out}


def test_order_code_follows_the_values(spark):
    rnd = random.Random(1)
    xs = [0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1, 0), math.nextafter(1, 2),
          -1.0, 1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 8.0, math.nextafter(8, 0)]
    xs += [struct.unpack("d", struct.pack("Q", rnd.getrandbits(64)))[0] for _ in range(3000)]
    xs += [s * 2.0 ** e * (1 + d * 2 ** -52) for e in range(-1022, 1023, 31) for d in (-1, 0, 1) for s in (1, -1)]
    xs = [x for x in xs if not math.isnan(x)]
    codes = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").selectExpr(ranks.order_code_sql("x")).collect()]
    for x, c in zip(xs, codes):
        bits = struct.unpack("q", struct.pack("d", abs(x)))[0]
        assert c == (-bits if x < 0 else bits), x


@pytest.mark.parametrize("seed", range(3))
def test_continuous_values(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {"normal": rng.normal(70, 12, 4001), "wide": rng.normal(0, 1, 2000) * 10.0 ** rng.integers(-200, 200, 2000),
              "ties": rng.integers(0, 3, 999) / 2, "one": np.array([3.25]), "two": np.array([1.0, 2.0]),
              "close": 1 + rng.integers(0, 50, 500) * 2.0 ** -52, "both": rng.uniform(-1e9, 1e9, 777), None: rng.exponential(5, 321)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("one", None), ("none", None), (None, None)]
    out = found(spark, rows)
    assert out["none"]["n"] == 1 and all(out["none"][p] is None for p in PROBS)
    for k, vs in groups.items():
        values = sorted(map(float, vs))
        for name, p in PROBS.items():
            assert out[k][name] == exact(values, p), (k, name)
    whole = sorted(float(v) for vs in groups.values() for v in vs)
    out = found(spark, rows, keys=())[None]
    assert [out[n] for n in PROBS] == [exact(whole, p) for p in PROBS.values()] and out["n"] == len(rows)


def test_infinite_and_nan(spark):
    out = found(spark, [("a", math.inf), ("a", 1.0), ("a", -math.inf), ("b", math.nan), ("b", 1.0), ("b", 2.0)])
    assert [out["a"][p] for p in ("p0", "p50", "p100")] == [-math.inf, 1.0, math.inf]
    assert out["b"]["p0"] == 1.0 and out["b"]["p50"] == 2.0 and math.isnan(out["b"]["p100"])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert ranks.with_percentiles(empty, ["k"], "x", ["count(1) AS n"], PROBS).count() == 0
    row = ranks.with_percentiles(empty, [], "x", ["count(1) AS n"], PROBS).first()
    assert row["n"] == 0 and row["p50"] is None


def test_agrees_with_percentile_on_continuous_readings(spark):
    """Readings without repeated values: the four queries, against the buffered aggregate."""
    r = adapter.readings(table(spark, SF_SMALL, "events")).selectExpr(
        "*", "40 + 60 * (pmod(reading_id * 7919.123456789, 997.0) / 997.0) AS c").drop("noise_level_db").withColumnRenamed("c", "noise_level_db")
    direct = {x["hour"]: (x["m"], x["p"]) for x in r.groupBy("hour").agg({"hour": "max"}).select("hour").join(
        r.selectExpr("hour", "noise_level_db AS v").groupBy("hour").agg(
            *[trends.E(s) for s in ("percentile(v, 0.5) AS m", "percentile(v, 0.95) AS p")]), "hour").collect()}
    for x in trends.hourly_trends(r).collect():
        assert (x["median_noise_db"], x["p95_noise_db"]) == pytest.approx(direct[x["hour"]], abs=0.0051)
    quartiles = r.selectExpr("percentile(noise_level_db, array(0.25, 0.5, 0.75))").first()[0]
    d = stats.noise_describe(r).first()
    assert [d["p25"], d["p50"], d["p75"]] == pytest.approx(quartiles, abs=6e-6)
    assert stats.noise_summary(r).first()["median_db"] == pytest.approx(quartiles[1], abs=0.0051)


def test_no_buffered_percentile_in_any_plan(spark):
    r = adapter.readings(table(spark, SF_SMALL, "events"))
    for df in (trends.hourly_trends(r), trends.summary_view(r), stats.noise_describe(r), stats.noise_summary(r)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "percentile" not in plan and "median(" not in plan


def test_rows_stay_where_they_are(spark):
    """A round shuffles counts per bucket: its scan has no exchange before the partial aggregate."""
    r = adapter.readings(table(spark, SF_SMALL, "events"), with_zone=False)
    rows = r.selectExpr("hour", "noise_level_db AS _x", f"{ranks.order_code_sql('noise_level_db')} AS _code")
    wanted = rows.groupBy("hour").agg(*[trends.E(s) for s in ("min(_code) AS lo", "max(_code) AS hi")]).selectExpr(
        "hour", "lo", "hi", "array(named_struct('id', 0, 'at', 5L)) AS ranks")
    plan = ranks._narrowed(rows, ranks.kept(wanted, "wanted"), ["hour"])._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, line in enumerate(plan.split("\n")) if "events.parquet" in line)
    above = plan.split("\n")[:scan]
    depth = next(i for i in range(scan, 0, -1) if "partial_count(1)" in plan.split("\n")[i])
    assert not any(" Exchange hash" in line for line in above[depth:])
