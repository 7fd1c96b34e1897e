"""Golden results for the line jobs (FIXTURES.md sections 1 and 2)."""

from quietude.operators import text

LINES = ["hadoop big data hadoop", "big data analytics", "hadoop analytics"]
STUDENTS = ["1 Rahul 85", "2 Aman 90", "3 Zaid 75"]


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_word_count(spark):
    out = {r["word"]: r["count"] for r in text.word_count(_lines(spark, LINES)).collect()}
    assert out == {"analytics": 2, "big": 2, "data": 2, "hadoop": 3}


def test_word_count_whitespace_runs(spark):
    out = {r["word"]: r["count"] for r in text.word_count(_lines(spark, ["  a\tb\r\n a ", ""])).collect()}
    assert out == {"a": 2, "b": 1}


def test_keyword_search(spark):
    rows = [(r["key"], r["line"]) for r in text.keyword_search(_lines(spark, LINES), "hadoop").collect()]
    assert sorted(rows) == [("Found", "hadoop analytics"), ("Found", "hadoop big data hadoop")]


def test_keyword_search_case_insensitive(spark):
    rows = text.keyword_search(_lines(spark, ["HADOOP rocks", "nothing"]), "hadoop").collect()
    assert [r["line"] for r in rows] == ["HADOOP rocks"]
    assert text.keyword_count(_lines(spark, LINES), "hadoop").first()["match_count"] == 2


def test_sort_by_name(spark):
    rows = [(r["name"], r["record"]) for r in text.sort_by_name(_lines(spark, STUDENTS)).collect()]
    assert rows == [("Aman", "2 Aman 90"), ("Rahul", "1 Rahul 85"), ("Zaid", "3 Zaid 75")]


def test_sort_drops_short_records_trailing_space(spark):
    # '1 Rahul ' has two parts once trailing separators are ignored.
    rows = text.sort_by_name(_lines(spark, ["1 Rahul ", "2 Aman 90", "x"])).collect()
    assert [r["name"] for r in rows] == ["Aman"]


def test_word_frequency_whole_runs(spark):
    df = spark.createDataFrame([("Café noise noise NOISE abc über_x road roads",)], "text string")
    out = {r["word"]: r["count"] for r in text.word_frequency(df).collect()}
    # 'café' is one run with an accent -> dropped; 'über_x' is one run -> dropped
    assert out == {"noise": 3, "road": 1, "roads": 1} or out == {"noise": 3, "roads": 1, "road": 1}
    assert "abc" not in out and "caf" not in out


def test_keyword_categories_multilabel(spark):
    df = spark.createDataFrame([("Loud music at the bar next door",), ("Dog barking",), ("quiet",)],
                               "text string")
    out = {r["category"]: (r["match_count"], r["match_pct"]) for r in text.keyword_categories(df).collect()}
    # substring semantics: 'barking' contains 'bar'
    assert out["entertainment"] == (2, 66.67)
    assert out["neighbors"] == (1, 33.33)
    assert out["animals"] == (1, 33.33)
    assert out["aircraft"] == (0, 0.0)
    assert len(out) == 8
