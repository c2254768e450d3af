"""Keyed tables in hash buckets that split as they grow, so that an upsert or a lookup touches only what it needs."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.joins import BROADCAST_ROWS, is_small, upsert
from riskloom.session import materialize
from riskloom.sources.versions import VersionLog

#: Rows of a bucket, which is what one task rewrites.
BUCKET_ROWS = 1_000_000
#: Keys that a lookup hands to the scan as a list.
LISTED_KEYS = 1000


class Bucket(NamedTuple):
    """The rows whose key hash starts with the `depth` bits of `prefix`, stored in `folder`."""

    depth: int
    prefix: int
    folder: str
    rows: int


_MANIFEST = "depth int, prefix bigint, folder string, rows bigint"


@dataclass(frozen=True)
class BucketedTable:
    """A keyed table below `root`, in buckets of at most `bucket_rows` rows.

    Buckets are leading bits of the key's hash, as many for each bucket as its rows need (extendible
    hashing). `data/<write>/bucket=<prefix>` holds rows sorted by key, and a manifest names the bucket
    folders of a version with their counted rows. An upsert rewrites the buckets of its keys, in smaller
    buckets if they overflow, and leaves all others. The driver holds one entry for each bucket.

    Every write and every manifest has a fresh name and is never changed, and a manifest is written after
    its data: readers see the old table or the new one, and a failed write leaves no trace in either.
    Versions are numbered by the writer, of which there is one at a time; a version that is written again
    after a failure, from the same input, has two equal manifests. Old folders are kept; give them a
    retention rule.
    """

    spark: SparkSession
    root: str
    key: str
    schema: T.StructType
    bucket_rows: int = BUCKET_ROWS
    _known: dict[int, list[Row]] = field(default_factory=dict, repr=False, compare=False)

    @staticmethod
    def create(df: DataFrame, root: str, key: str, bucket_rows: int = BUCKET_ROWS, rows: int | None = None) -> BucketedTable:
        """Store `df`, which has `rows` rows (counted if not given), as version 0."""
        table = BucketedTable(df.sparkSession, root, key, df.schema, bucket_rows)
        rows = df.count() if rows is None else rows
        table._write_manifest(table._write(df, table._splits(rows)) if rows else [], 0)
        return table

    def _splits(self, rows: int) -> int:
        """Bits by which so many rows are split. Buckets are filled to four fifths, as hashes are not quite even."""
        return max(0, math.ceil(math.log2(max(rows, 1) / (0.8 * self.bucket_rows))))

    def _prefix(self, depth: int) -> Column:
        key = F.col(self.key).cast(self.schema[self.key].dataType)
        return F.shiftrightunsigned(F.xxhash64(key), 64 - depth) if depth else F.lit(0).cast("bigint")

    def _write(self, df: DataFrame, depth: int) -> list[Bucket]:
        """Store rows in buckets of `depth` bits, and those that are still too large in deeper ones."""
        name = uuid.uuid4().hex
        path = f"{self.root}/data/{name}"
        placed = df.select(*self.schema.names, self._prefix(depth).alias("bucket")).repartition("bucket")
        placed.sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").parquet(path)
        stored = self.spark.read.schema(T.StructType([T.StructField("bucket", T.LongType())])).parquet(path)
        found = [Bucket(depth, r[0], f"{name}/bucket={r[0]}", r[1]) for r in stored.groupBy("bucket").count().collect()]
        large = [b for b in found if b.rows > self.bucket_rows and depth < 60]
        if not large:
            return found
        deeper = depth + max(1, self._splits(max(b.rows for b in large)))
        return [b for b in found if b not in large] + self._write(self._read(large), deeper)

    @property
    def _log(self) -> VersionLog:
        return VersionLog(self.spark, f"{self.root}/manifest", _MANIFEST, self._known)

    def _write_manifest(self, buckets: list[Bucket], version: int) -> None:
        self._log.write([tuple(b) for b in sorted(buckets)], version)

    def manifest(self, version: int) -> list[Bucket]:
        """The buckets of a version that have rows."""
        return [Bucket(*row) for row in self._log.read(version)]

    def newest(self) -> int:
        return self._log.newest()

    def _read(self, buckets: list[Bucket]) -> DataFrame:
        paths = [f"{self.root}/data/{b.folder}" for b in sorted(buckets)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default."""
        return self._read(self.manifest(self.newest() if version is None else version))

    def _touched(self, keys: DataFrame, buckets: list[Bucket]) -> tuple[dict[Bucket, int], dict[int, int], int]:
        """Of `keys` the rows for each bucket, and for each prefix without a bucket, at the greatest depth there is."""
        depth = max((b.depth for b in buckets), default=0)
        counts = keys.groupBy(self._prefix(depth).alias("p")).count().collect()
        known, depths = {(b.depth, b.prefix): b for b in buckets}, sorted({b.depth for b in buckets})
        rows: dict[Bucket, int] = {}
        free: dict[int, int] = {}
        for prefix, n in counts:
            bucket = next((known[d, prefix >> depth - d] for d in depths if (d, prefix >> depth - d) in known), None)
            if bucket is None:
                free[prefix] = n
            else:
                rows[bucket] = rows.get(bucket, 0) + n
        return rows, free, depth

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The rows with the given keys. Only the buckets of the keys are read, and of those, as their
        files are sorted by key, the parts that hold the keys if they are few, or their range."""
        wanted = materialize(keys.select(F.col(self.key).cast(self.schema[self.key].dataType)).distinct(), "lookup-keys")
        buckets = self.manifest(self.newest() if version is None else version)
        touched, _, _ = self._touched(wanted, buckets)
        rows = self._read(list(touched))
        low, high, n = wanted.agg(F.min(self.key), F.max(self.key), F.count(self.key)).first()
        if not n:
            return rows.limit(0)
        if n <= LISTED_KEYS:
            return rows.where(F.col(self.key).isin([row[0] for row in wanted.where(F.col(self.key).isNotNull()).collect()]))
        near = rows.where(F.col(self.key).between(F.lit(low), F.lit(high)))
        small = n <= BROADCAST_ROWS and is_small(wanted)
        return near.join(F.broadcast(wanted) if small else wanted, self.key, "left_semi")

    def upsert(self, changes: DataFrame, increments: tuple[str, ...] = (), version: int | None = None) -> int:
        """Apply changes with unique keys to version `version`, the newest by default; returns the new version."""
        before = self.newest() if version is None else version
        buckets = self.manifest(before)
        changes = materialize(changes.withColumn(self.key, F.col(self.key).cast(self.schema[self.key].dataType)), "changes")
        touched, free, deepest = self._touched(changes, buckets)
        kept = [b for b in buckets if b not in touched]
        if touched or free:
            # One depth for all that is written: the hash is even, so that the buckets' needs differ little.
            depth = max([b.depth + self._splits(b.rows + n) for b, n in touched.items()] + [deepest + self._splits(n) for n in free.values()])
            merged = upsert(self._read(list(touched)), changes, self.key, increments)
            kept = kept + self._write(merged, depth)
        self._write_manifest(kept, before + 1)
        return before + 1
