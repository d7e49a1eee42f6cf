"""Published snapshots in buckets by key hash.

A snapshot has one row per key. It is stored in a fixed number of buckets; inside
a bucket rows are sorted by key, and the files carry Bloom filters of the keys.
A version is a manifest: the folder of each bucket, which may have been written
by an earlier version. So a refresh writes only the buckets whose keys changed,
and a lookup of few keys opens only the files of their buckets.

Versions are published by one line in a list, as in
:func:`tablewright.sources.tables.publish_snapshot`.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.naming import quoted
from tablewright.sources.tables import instant, path_exists

LOG, MANIFESTS, DATA = "published", "manifests", "data"
BUCKET = "key_bucket"


@dataclass(frozen=True)
class Version:
    """What is published: ``until`` bounds the event times served, ``seen`` the
    creation times read so far, as text; ``paths`` are the folders of the
    buckets that hold rows, relative to the root."""

    name: str
    until: str
    seen: str | None
    schema: T.StructType
    paths: dict[int, str]


def bucket_of(keys: Sequence[str], types: Sequence[T.DataType], buckets: int) -> Column:
    """The bucket of a row, by the hash of its keys in their declared types."""
    typed = [F.col(quoted(k)).cast(t) for k, t in zip(keys, types)]
    return F.pmod(F.xxhash64(*typed), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class BucketStore:
    """The place of a snapshot. ``key_types`` are DDL types; ``buckets`` holds
    for all versions: about as many as give files of the size you want, and a
    few times the number of tasks that refresh it."""

    root: str
    keys: tuple[str, ...]
    key_types: tuple[str, ...]
    buckets: int = 64

    def bucket(self) -> Column:
        types = [T.DataType.fromDDL(t) for t in self.key_types]
        return bucket_of(self.keys, types, self.buckets)

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def current(self, spark: SparkSession) -> Version | None:
        """The newest published version, or None before the first."""
        if not path_exists(spark, self._at(LOG)):
            return None
        lines = spark.read.schema(
            "version string, until string, seen string, buckets int, schema string, published timestamp"
        )
        newest = lines.json(self._at(LOG)).orderBy(F.desc("published"), F.desc("version")).head(1)
        if not newest:
            return None
        line = newest[0]
        if line["buckets"] != self.buckets:
            raise ValueError(f"the store at {self.root} has {line['buckets']} buckets, not {self.buckets}")
        # One row per bucket.
        rows = spark.read.schema("bucket int, path string").json(self._at(MANIFESTS, f"v-{line['version']}"))
        paths = {r["bucket"]: r["path"] for r in rows.collect() if r["path"] is not None}
        schema = T.StructType.fromJson(json.loads(line["schema"]))
        return Version(line["version"], line["until"], line["seen"], schema, paths)

    def read(self, spark: SparkSession, version: Version, only: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets. Folders of other
        buckets are not even listed."""
        wanted = sorted(version.paths if only is None else set(only) & set(version.paths))
        paths = [self._at(version.paths[b]) for b in wanted]
        if not paths:
            return spark.createDataFrame([], version.schema)
        reader = spark.read.schema(version.schema).option("recursiveFileLookup", "true")
        return reader.parquet(*paths)

    def write(self, table: DataFrame, name: str) -> dict[int, str]:
        """Store rows under a version's name, not published yet; returns the
        folders of the buckets that got rows. One shuffle, of these rows only."""
        if BUCKET in table.columns:
            raise ValueError(f"the table has a column {BUCKET} of its own")
        spark, path = table.sparkSession, self._at(DATA, f"v-{name}")
        placed = table.withColumn(BUCKET, self.bucket())
        placed = placed.repartition(self.buckets, BUCKET).sortWithinPartitions(BUCKET, *map(quoted, self.keys))
        writer = placed.write.partitionBy(BUCKET).mode("overwrite")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.parquet(path)
        # The folders say which buckets there are: names only, one per bucket.
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()]
        found = [n for n in names if n.startswith(f"{BUCKET}=")]
        return {int(n.split("=", 1)[1]): f"{DATA}/v-{name}/{n}" for n in found}

    def publish(
        self,
        spark: SparkSession,
        name: str,
        until: str | datetime,
        seen: str | None,
        schema: T.StructType,
        paths: dict[int, str],
    ) -> Version:
        """Write the manifest of all buckets, then the line that makes it current."""
        manifest = spark.createDataFrame(
            [(b, paths.get(b)) for b in range(self.buckets)], "bucket int, path string"
        )
        manifest.coalesce(1).write.mode("overwrite").json(self._at(MANIFESTS, f"v-{name}"))
        line = spark.range(1).select(
            F.lit(name).alias("version"),
            F.lit(instant(until)).alias("until"),
            F.lit(seen).cast("string").alias("seen"),
            F.lit(self.buckets).alias("buckets"),
            F.lit(schema.json()).alias("schema"),
            F.current_timestamp().alias("published"),
        )
        line.write.mode("append").json(self._at(LOG))
        return Version(name, instant(until), seen, schema, dict(paths))

    def drop_unused(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Delete the folders of buckets that none of the newest ``keep`` versions
        refers to, and return them. Readers of older versions must be done, and no
        refresh may be running: what it wrote is not published yet."""
        if keep < 1:
            raise ValueError("the current version must be kept")
        if not path_exists(spark, self._at(LOG)):
            return []
        lines = spark.read.schema("version string, published timestamp").json(self._at(LOG))
        names = [r["version"] for r in lines.orderBy(F.desc("published"), F.desc("version")).head(keep)]
        manifests = [self._at(MANIFESTS, f"v-{name}") for name in names]
        rows = spark.read.schema("bucket int, path string").json(manifests)
        # One row per bucket and kept version.
        used = {r["path"] for r in rows.where("path IS NOT NULL").distinct().collect()}
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self._at(DATA))
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        dropped = []
        for version in files.listStatus(root) if files.exists(root) else []:
            for folder in files.listStatus(version.getPath()):
                path = f"{DATA}/{version.getPath().getName()}/{folder.getPath().getName()}"
                if folder.isDirectory() and path not in used:
                    files.delete(folder.getPath(), True)
                    dropped.append(path)
        return sorted(dropped)
