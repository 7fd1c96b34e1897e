"""Exact fixed-point moments: merged in any order, without a row limit."""

import math
import random
from fractions import Fraction

import pytest

from quietude.functions import exact
from quietude.operators import stats, trends
from quietude.sources import adapter
from quietude.sources.tables import table
from tests.conftest import SF_SMALL

LIMB = exact.LIMB


def moments(values):
    """Exact mean and variances of whole units, as fractions."""
    n, s = len(values), sum(values)
    centred = sum(v * v for v in values) - Fraction(s * s, n)
    return Fraction(s, n), centred / n, centred / (n - 1) if n > 1 else None


@pytest.mark.parametrize("top", [10 ** 2, 10 ** 8, 10 ** 12, 9 * 10 ** 18])
def test_sums_and_variance(spark, top):
    rnd = random.Random(top)
    units = [rnd.randint(-top, top) for _ in range(500)] + [top, -top, 0]
    # Whole units are handed over as they are: x = units * 10**-6 would round.
    df = spark.createDataFrame([(u,) for u in units], "u long")
    aggs = [a.replace(exact.units_sql("x"), "u").replace("count(x)", "count(u)") for a in exact.sums_sql("x")]
    row = df.repartition(7).selectExpr(*aggs).selectExpr(
        "*", f"{exact.mean_sql()} AS mean", f"{exact.variance_sql()} AS var", f"{exact.variance_sql(sample=True)} AS samp").first()
    assert row["n"] == len(units) and row["s"] == sum(units)
    assert int(row["q_hi"]) * LIMB + int(row["q_lo"]) == sum(u * u for u in units)
    mean, var, samp = moments(units)
    assert row["mean"] == pytest.approx(float(mean / 10 ** 6), rel=1e-14)
    assert row["var"] == pytest.approx(float(var / 10 ** 12), rel=1e-12)
    assert row["samp"] == pytest.approx(float(samp / 10 ** 12), rel=1e-12)


def test_variance_of_close_values(spark):
    """Far from zero with little spread: where sum(x*x)/n - mean*mean has nothing left."""
    units = [8 * 10 ** 18 + d for d in (0, 1, 2, 3, 4)] * 20
    df = spark.createDataFrame([(u,) for u in units], "u long")
    aggs = [a.replace(exact.units_sql("x"), "u").replace("count(x)", "count(u)") for a in exact.sums_sql("x")]
    assert df.selectExpr(*aggs).selectExpr(f"{exact.variance_sql()} AS v").first()["v"] == pytest.approx(2e-12, rel=1e-12)


def partial(key, units, times):
    n, s, squares = len(units) * times, sum(units) * times, sum(u * u for u in units) * times
    return (key, n, s, squares // LIMB, squares % LIMB, min(units) / 1e6, max(units) / 1e6)


SCHEMA = "key string, n long, s decimal(38,0), q_hi decimal(38,0), q_lo decimal(38,0), min_x double, max_x double"


def test_a_trillion_rows(spark):
    """Partials of 10**12 rows and more a group (the products had overflowed)."""
    from decimal import Decimal
    base = [40_000_000, 99_123_456, 104_999_999, 70_000_001]
    rows = [partial("a", base, 10 ** 12), partial("a", base, 3 * 10 ** 12), partial("b", [104_999_999, 105_000_000], 10 ** 18),
            partial("c", [9 * 10 ** 18, 8 * 10 ** 18], 10 ** 12), partial("d", [7], 1)]
    rows = [(k, n, Decimal(s), Decimal(h), Decimal(q), a, b) for k, n, s, h, q, a, b in rows]
    out = {r["key"]: r for r in stats.moments_merge(spark.createDataFrame(rows, SCHEMA)).collect()}
    for key, units in (("a", base), ("b", [104_999_999, 105_000_000]), ("d", [7])):
        mean, var, _ = moments(units)
        assert out[key]["mean_db"] == round(float(mean) / 1e6, 2)
        assert out[key]["std_dev"] == pytest.approx(math.sqrt(var) / 1e6, abs=0.0051)
    assert out["a"]["count"] == 16 * 10 ** 12 and out["c"]["std_dev"] == pytest.approx(5e11, rel=1e-9)


def test_any_split_gives_the_same_bits(spark):
    r = adapter.readings(table(spark, SF_SMALL, "events")).selectExpr(
        "*", "noise_level_db + pmod(reading_id * 0.0123457, 1.0) AS c").drop("noise_level_db").withColumnRenamed("c", "noise_level_db")
    want = sorted(map(str, trends.export_aggregates(r).collect()))
    for n in (1, 3, 17):
        assert sorted(map(str, trends.export_aggregates(r.repartition(n)).collect())) == want
    direct = sorted(map(str, stats.moments_merge(stats.moments_partial(r, ())).collect()))
    for split in (("date",), ("date", "participant_id"), ("participant_id",)):
        parts = stats.moments_partial(r, split)
        assert sorted(map(str, stats.moments_merge(parts.repartition(5)).collect())) == direct


def test_weighted_sums_and_no_values(spark):
    df = spark.createDataFrame([(1.5, 4), (2.25, 2), (None, 9)], "x double, w long")
    row = df.selectExpr(*exact.sums_sql("x", "w")).selectExpr("n", f"{exact.mean_sql()} AS m", f"{exact.variance_sql()} AS v").first()
    assert tuple(row) == (6, 1.75, 0.125)
    none = df.where("x IS NULL").selectExpr(*exact.sums_sql("x")).selectExpr("n", f"{exact.mean_sql()} AS m", f"{exact.std_sql()} AS v").first()
    assert none["n"] == 0 and none["m"] is None and none["v"] is None
