"""A keyed table on plain Parquet: upserts that write only what they change (K8).

Rows lie in buckets by the hash of their key. An upsert reads and rewrites the
buckets that its batch hits; the others keep their files. Which version of a
bucket is live stands in a manifest, a small table of (bucket, version), one
per upsert; a manifest appears by one rename after all files are written. A
write that fails leaves the last manifest and so the table as it was, readers
see one state or the other, and earlier versions can be read until ``vacuum``.
Two upserts at a time want the same manifest; the later one fails and can be
run again.

    path/data/v=<version>/bucket=<bucket>/*.parquet
    path/manifest/<version>/*.json
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietude.sinks.writers import upsert

_BUCKET = "bucket"


class KeyedTable:
    """``key``: the columns that name a row (NULL is a value like any other);
    ``buckets``: how many buckets a new table has (an existing one keeps its own)."""

    def __init__(self, spark: SparkSession, path: str, key: list[str] | str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.buckets = buckets

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    @property
    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Versions that can be read, oldest first."""
        found = self._fs.globStatus(self._path("manifest", "[0-9]*")) or []
        return sorted(int(f.getPath().getName()) for f in found)

    def manifest(self, version: int | None = None) -> tuple[int, dict[int, int]]:
        """The number of buckets, and the live version of each bucket with rows."""
        version = self.versions()[-1] if version is None else version
        rows = (self.spark.read.schema("buckets int, bucket int, version int")
                .json(self._path("manifest", str(version)).toString()).collect())  # one row per bucket
        return rows[0]["buckets"], {r["bucket"]: r["version"] for r in rows if r["bucket"] is not None}

    def _read(self, live: dict[int, int], only: set[int] | None = None) -> DataFrame | None:
        folders = [self._path("data", f"v={v}", f"{_BUCKET}={b}").toString()
                   for b, v in sorted(live.items()) if only is None or b in only]
        return self.spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (default: the last)."""
        rows = self._read(self.manifest(version)[1])
        if rows is None:
            raise ValueError(f"no rows in {self.path}")
        return rows

    def upsert(self, new: DataFrame, order: list[str] | str = ()) -> set[int]:
        """Rows of ``new`` replace the rows of their keys (of several with one key
        the last by ``order``); gives the buckets that were written."""
        versions = self.versions()
        last = versions[-1] if versions else 0
        buckets, live = self.manifest(last) if versions else (self.buckets, {})
        place = F.pmod(F.xxhash64(*[F.col(k) for k in self.key]), F.lit(buckets)).cast("int").alias(_BUCKET)
        hit = {r[0] for r in new.select(place).distinct().collect()}  # at most one row per bucket
        if not hit and versions:
            return hit
        merged = upsert(self._read(live, hit), new, self.key, order)
        # A version that failed may have left files under its number: take one that nobody used.
        version = last + 1
        while self._fs.exists(self._path("data", f"v={version}")):
            version += 1
        dealt = merged.select("*", place).repartition(max(1, len(hit)), _BUCKET)
        dealt.write.partitionBy(_BUCKET).parquet(self._path("data", f"v={version}").toString())
        live = live | {b: version for b in hit}
        rows = [(buckets, b, v) for b, v in sorted(live.items())] or [(buckets, None, None)]
        fresh = self._path(f"_manifest-{uuid.uuid4().hex}")
        (self.spark.createDataFrame(rows, "buckets int, bucket int, version int").coalesce(1).write.json(fresh.toString()))
        self._fs.mkdirs(self._path("manifest"))
        target = self._path("manifest", str(version))
        if max(self.versions(), default=0) != last or self._fs.exists(target) or not self._fs.rename(fresh, target):
            raise RuntimeError(f"{self.path} was changed meanwhile; run the upsert again")
        return hit

    def vacuum(self, keep: int = 1) -> list[int]:
        """Drop all but the last ``keep`` manifests and the files that none of these
        names; gives the versions that went."""
        versions = self.versions()
        gone = versions[:-keep]
        named = {(b, v) for version in versions[-keep:] for b, v in self.manifest(version)[1].items()}
        for f in self._fs.globStatus(self._path("data", "v=*", f"{_BUCKET}=*")) or []:
            folder = f.getPath()
            place = int(folder.getName().partition("=")[2]), int(folder.getParent().getName().partition("=")[2])
            if place not in named:
                self._fs.delete(folder, True)
        for version in gone:
            self._fs.delete(self._path("manifest", str(version)), True)
        return gone
