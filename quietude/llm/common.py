"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quietude.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Lets Spark delete a query's shuffle files when the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that go to a Python worker together.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def _storing(spark: SparkSession, arrow_bytes: int | None) -> Iterator[None]:
    """The settings of a query whose rows are stored: its shuffle files go when it ends,
    and batches for Python workers have at most ``arrow_bytes``."""
    settings = {SHUFFLE_CLEANUP: "true"}
    if arrow_bytes is not None:
        usual = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ARROW_BYTES))
        settings[ARROW_BYTES] = str(min(usual, arrow_bytes))
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(df: DataFrame, name: str, arrow_bytes: int | None = None, in_blocks: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor rereads the files instead of running
    the plan again, and values such as row numbers stay what they were. Each
    call takes a fresh folder; ``discard`` deletes it, or the session when the
    driver ends. The shuffle files of the query go as soon as the table is written.
    ``arrow_bytes`` bounds the batches that this query hands to Python workers: both
    the executor and the worker hold them whole.

    ``in_blocks`` keeps the rows as blocks on the executors' disks instead, once they are
    first read. Lost blocks are made again, so the plan must give the same rows each time;
    its shuffle files stay as long as the blocks. No task creates files through Hadoop then:
    on local paths that spawns a process for each, to set its mode, and until that has
    started its program it counts with all of the executor's memory.
    """
    if in_blocks:
        # A plan of its own: Spark takes the blocks of an equal one, even if its input file was replaced since.
        return df.where(F.lit(uuid.uuid4().hex) != "").persist(StorageLevel.DISK_ONLY)
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quietude-{name}-{uuid.uuid4().hex}"
    with _storing(spark, arrow_bytes):
        df.write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def held(df: DataFrame, arrow_bytes: int | None = None) -> DataFrame:
    """Make the rows of ``df`` now and keep them as blocks on the disks of two executors each.

    For small tables that would be many small files, above all those of a loop: the
    lineage is cut as ``stored`` cuts it, the shuffle files go, and no task creates a file
    through Hadoop (see ``in_blocks`` there for what that costs on local paths). The blocks
    outlive the loss of one executor, not of both; they go when the table is no longer
    referred to. Join keys that may be frequent belong in ``stored``: Spark remembers how
    blocks are partitioned, shuffles the other side alone, and then splits no skewed partition.
    """
    with _storing(df.sparkSession, arrow_bytes):
        return df.localCheckpoint(True, StorageLevel.DISK_ONLY_2)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` gave, once all that is made of them is stored too."""
    for df in tables:
        jpath = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(df))
        jpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jpath, True)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """The column of this exact name (dots and blanks are part of it)."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; NULL counts as empty.

    All-ASCII texts take the fast built-in; others go through a translation
    that leaves every letter beyond ASCII as it is.
    """
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.octet_length(t) == F.length(t), F.lower(t))
            .otherwise(F.translate(t, UPPER, LOWER)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_filter(keys: DataFrame, rows: int, max_bits: int = 1 << 27) -> np.ndarray:
    """A bitmap of the keys in the first column: for ``in_filter`` in tasks if they
    are binary, for ``longs_in_filter`` if they are longs (well mixed ones).

    About 8 bits for each of ``rows`` expected keys, at most ``max_bits``: with
    more keys it fills up, and tests pass more keys that are not in it.
    """
    bits = min(max_bits, 1 << max(15, math.ceil(math.log2(max(1, rows) * 8))))
    name = keys.columns[0]
    # The low bits of the first eight bytes, little-endian, as in_filter reads them.
    value = F.col(name) if keys.dtypes[0][1] == "bigint" else F.expr(
        f"CAST(conv(concat(hex(substring({name}, 4, 1)), hex(substring({name}, 3, 1)), "
        f"hex(substring({name}, 2, 1)), hex(substring({name}, 1, 1))), 16, 10) AS BIGINT)")
    cells = keys.select((F.pmod(value, F.lit(bits)) + 1).alias("cell"))
    parts = (cells.groupBy(F.expr("bitmap_bucket_number(cell)").alias("bucket"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell))").alias("bitmap")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in parts:
        out[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(r["bitmap"], np.uint8)
    return out


def in_filter(key: bytes, bitmap: np.ndarray) -> bool:
    """Whether ``key_filter`` may have been given the key."""
    cell = int.from_bytes(key[:4], "little") % (len(bitmap) * 8)
    return bool(bitmap[cell >> 3] >> (cell & 7) & 1)


def longs_in_filter(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether ``key_filter`` may have been given each of the longs."""
    cell = np.mod(keys, len(bitmap) * 8)
    return (bitmap[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
