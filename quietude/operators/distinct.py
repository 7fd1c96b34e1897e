"""Distinct counts that merge (A19): bitmaps of numbered ids per day.

Every id gets a number once, kept in a dictionary. A day's ids are a bitmap,
cut in buckets of 32,768 numbers (4 KB each). Bitmaps of any days are merged by
OR, so the distinct ids of any range of days are counted from at most one row
per day and bucket, and the readings are not read again. Counts are exact.

Numbers are dense within each task that gave them, not over all, so numbering
takes no global rank and no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietude.functions.expr import E, q

BUCKET = 32768


def numbered(values: DataFrame, col: str, known: DataFrame | None = None) -> DataFrame:
    """The dictionary (value, number) of a column's non-NULL values. With
    ``known``, its numbers stay and new values get higher ones.

    Store it before use: a number is given once."""
    new = values.select(F.col(col).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    if known is None:
        return new.select("value", (F.monotonically_increasing_id() + 1).alias("number"))
    new = new.join(known, "value", "left_anti")
    first = known.agg(E(f"(coalesce(max(number), 0L) div {BUCKET} + 1) * {BUCKET}L AS first")).scalar()
    return known.unionByName(new.select("value", (F.monotonically_increasing_id() + first + 1).alias("number")))


def day_bitmaps(rows: DataFrame, col: str, dictionary: DataFrame, day: Column | None = None) -> DataFrame:
    """Per day and bucket, which numbers occur: date, bucket, bitmap.

    Each id is sent once per day and task at most."""
    day = E("to_date(`timestamp`)") if day is None else day
    seen = rows.select(day.alias("date"), F.col(col).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    return (seen.join(dictionary, "value")
            .groupBy("date", E("bitmap_bucket_number(number) AS bucket"))
            .agg(E("bitmap_construct_agg(bitmap_bit_position(number)) AS bitmap")))


def merged(bitmaps: DataFrame, by: list[str] = ()) -> DataFrame:
    """Distinct ids per ``by`` (none: overall), as ``distinct_ids``."""
    whole = bitmaps.groupBy(*by, "bucket").agg(E("bitmap_or_agg(bitmap) AS bitmap"))
    return whole.groupBy(*by).agg(E("coalesce(sum(bitmap_count(bitmap)), 0L) AS distinct_ids"))


def trailing(bitmaps: DataFrame, days: int = 7) -> DataFrame:
    """For each day with readings, the distinct ids of the ``days`` days that end
    with it: date, distinct_ids."""
    own = bitmaps.select("date").distinct()
    spread = bitmaps.selectExpr(f"explode(sequence(0, {days - 1})) AS ahead", "*").selectExpr("date_add(date, ahead) AS date", "bucket", "bitmap")
    return merged(spread.join(own, "date", "left_semi"), ["date"])


def between(bitmaps: DataFrame, first: str, last: str) -> DataFrame:
    """The distinct ids from day ``first`` to day ``last``."""
    return merged(bitmaps.filter(f"{q('date')} BETWEEN DATE'{first}' AND DATE'{last}'"))
