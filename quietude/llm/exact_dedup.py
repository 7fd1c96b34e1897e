"""Exact deduplication with a two-pass Bloom filter (DataFrame functions only).

Pass one hashes every row's text and counts, for each of the ``HASHES`` filter
cells of a hash, how many rows hit it. Cells hit twice or more form the
filter: a repeated text hits all its cells at least twice, so no copy is
missed. Pass two tests each row against the filter. Rows that fail the test
are certainly unique and pass straight through; only the others shuffle, by
their SHA-256, and are grouped exactly. False positives cost a shuffle of
their row and never change the result.

The filter is broadcast as bitmaps of 4 KB. Its size is chosen from the row
count and bounded by ``max_bits`` (2**28 bits, 32 MB): beyond some 2**28 rows
it fills up, more rows shuffle, and the result stays the same.

Defined cases: a NULL text counts as empty and equals other empty texts. A
NULL id ranks below every other id. Of rows that agree in text and id (repeated
rows) exactly one is kept. An empty table gives no rows. Extra columns, also
ones named like the result's, are ignored by ``label_copies`` and carried
along by ``drop_copies``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietude.llm.common import ascii_lower, fresh_name, quoted, stored

HASHES = 2
MAX_BITS = 1 << 28
MIN_BITS = 1 << 15  # one bitmap


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """Cells for ``rows`` rows: 16 a row, a power of two, within the bounds."""
    return max(MIN_BITS, min(max_bits, 1 << math.ceil(math.log2(max(1, rows) * 16))))


def _cell(key: str, i: int, bits: int) -> Column:
    """The i-th filter cell of a row's key, from 1 (as the bitmap functions count)."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(bits)) + 1


def repeated_cells(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the filter cells that two rows or more hit."""
    cells = keys.select(F.explode(F.array(*[_cell(key, i, bits) for i in range(HASHES)])).alias("cell"))
    return (cells.groupBy("cell").count().where("count > 1")
            .groupBy(F.expr("bitmap_bucket_number(cell)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell))").alias("bitmap")))


def all_cells(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the filter cells that any row hits."""
    cells = keys.select(F.explode(F.array(*[_cell(key, i, bits) for i in range(HASHES)])).alias("cell"))
    return (cells.groupBy(F.expr("bitmap_bucket_number(cell)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell))").alias("bitmap")))


def split_by_keys(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``df`` whose key may be among ``keys`` (a stored table with a column
    of the same name), those whose key is certainly not, and the filter's stored bitmaps."""
    bits = filter_bits(keys.count())
    bitmaps = stored(all_cells(keys, key, bits), "bloom")
    maybe = fresh_name(df, "maybe")
    tested = with_filter_test(df, key, bitmaps, bits, maybe)
    return tested.where(F.col(maybe)).drop(maybe), tested.where(~F.col(maybe)).drop(maybe), bitmaps


def with_filter_test(df: DataFrame, key: str, bitmaps: DataFrame, bits: int, out: str) -> DataFrame:
    """Add ``out``: whether all cells of the row's key are in the filter."""
    columns, test = df.columns, F.lit(True)
    for i in range(HASHES):
        cell, bucket, bitmap = (fresh_name(df, f"{n}{i}") for n in ("cell", "bucket", "bitmap"))
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap)))
        df = df.withColumn(cell, _cell(key, i, bits))
        df = df.join(side, F.expr(f"bitmap_bucket_number({cell})") == F.col(bucket), "left")
        byte = F.expr(f"conv(hex(substring({bitmap}, CAST(bitmap_bit_position({cell}) DIV 8 AS INT) + 1, 1)), 16, 10)")
        bit = F.expr(f"CAST(bitmap_bit_position({cell}) % 8 AS INT)")
        test = test & F.coalesce(F.getbit(byte.cast("int"), bit) == 1, F.lit(False))
    return df.select(*[quoted(c) for c in columns], test.alias(out))


def label_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised texts, the one with the largest id is kept.
    """
    keyed = stored(docs.select(quoted(id_col).alias("id"),
                               F.sha2(ascii_lower(quoted(text_col)), 256).alias("sha"),
                               F.monotonically_increasing_id().alias("row")), "digests")
    bits = filter_bits(keyed.count(), max_bits)
    bitmaps = stored(repeated_cells(keyed, "sha", bits), "bloom")
    tested = with_filter_test(keyed, "sha", bitmaps, bits, "maybe")
    # Both sides of the join are read from files, so each gets an exchange of
    # its own and a hot text's rows can be split over tasks.
    groups = stored(tested.where("maybe").groupBy("sha")
                    .agg(F.count("*").alias("n"), F.max(F.struct("id", "row")).alias("top"))
                    .where("n > 1").selectExpr("sha AS group_sha", "n", "top"), "groups")
    copies = (tested.where("maybe").join(groups, F.col("sha") == F.col("group_sha"), "left")
              .selectExpr("id", "coalesce(top.id, id) AS keep_id", "coalesce(n, 1L) AS group_size",
                          "coalesce(top.row, row) = row AS kept", "sha AS text_sha256"))
    alone = tested.where("NOT maybe").selectExpr("id", "id AS keep_id", "1L AS group_size",
                                                 "true AS kept", "sha AS text_sha256")
    return copies.unionByName(alone).withColumnRenamed("id", id_col)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Unique rows pass through without a shuffle. Of possibly repeated rows,
    the group's keeper is found by a partial aggregate, so copies vanish on
    the map side and a hot text sends one row per task.
    """
    sha, maybe, row = (fresh_name(docs, n) for n in ("sha", "maybe", "row"))
    hashed = docs.withColumn(sha, F.sha2(ascii_lower(quoted(text_col)), 256))
    keys = stored(hashed.select(F.col(sha).alias("sha")), "digests")
    bits = filter_bits(keys.count(), max_bits)
    bitmaps = stored(repeated_cells(keys, "sha", bits), "bloom")
    tested = with_filter_test(hashed, sha, bitmaps, bits, maybe)
    columns = [quoted(c) for c in docs.columns]
    plain = [quoted(f.name) for f in docs.schema if not f.dataType.typeName() in ("map", "variant")]
    keepers = (tested.where(F.col(maybe)).groupBy(sha)
               .agg(F.max_by(F.struct(*columns), F.struct(quoted(id_col), F.xxhash64(*plain))).alias(row))
               .select(*[F.col(row).getField(c).alias(c) for c in docs.columns]))
    return tested.where(~F.col(maybe)).select(*columns).unionByName(keepers)
