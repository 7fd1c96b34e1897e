"""Most frequent values behind a bounded summary: equal to a plain count for any data."""

import random
from collections import Counter

import pytest

from quietude.operators import text
from quietude.operators.frequent import top_values
from quietude.sources.tables import table
from tests.conftest import SF_SMALL


def brute(values, n):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]


def run(spark, values, n, **how):
    df = spark.createDataFrame([(v,) for v in values], "`a b` string").repartition(5)
    return [tuple(r) for r in top_values(df, "a b", n, **how).collect()]


def skewed(seed, size=4000):
    """A third of the rows hold one value, others fall off, many occur once."""
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 1 / 3 else f"v{int(rnd.paretovariate(0.7))}") if rnd.random() < 0.9 else None
            for _ in range(size)]


@pytest.mark.parametrize("how", [{}, {"cells": 4, "probe": 1}, {"cells": 1}, {"cells": 300, "probe": 2}, {"cells": 64, "probe": 64}])
@pytest.mark.parametrize("n", [1, 7, 10_000])
def test_as_a_plain_count(spark, how, n):
    values = skewed(n)
    assert run(spark, values, n, **how) == brute(values, n)


def test_flat_counts_and_ties_need_the_third_scan(spark):
    values = [f"w{i:04d}" for i in range(900)] * 3
    for how in ({}, {"cells": 256, "probe": 3}):
        assert run(spark, values, 5, **how) == [(f"w{i:04d}", 3) for i in range(5)]


def test_empty_and_null(spark):
    assert run(spark, [], 3) == [] and run(spark, [None, None], 3) == [] and run(spark, ["", "", None], 3) == [("", 2)]


def test_words_outside_the_fullest_cells_are_not_counted(spark):
    """The second scan groups only the probed cells' words."""
    values = ["hot"] * 500 + [f"x{i}" for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = top_values(df, "v", 1, cells=1 << 12, probe=1)
    assert [tuple(r) for r in out.collect()] == [("hot", 500)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan  # read back: no third scan


def test_words_as_word_frequency(spark):
    docs = table(spark, SF_SMALL, "documents")
    for top in (1, 20, 500):
        assert text.word_frequency_bounded(docs, top=top).collect() == text.word_frequency(docs, top=top).collect()
