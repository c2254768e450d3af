"""Mergeable aggregates stored by period, of which only the changed periods are written anew."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources.versions import VersionLog

_EMPTY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class PeriodStore:
    """Sums and counts by keys, in one folder for each value of the key `period`.

    `data/<write>/period=<value>` holds rows, and a version log names the folder of each period, so that
    readers see the old table or the new one. The driver holds one entry for each period. Old folders
    are kept; give them a retention rule.
    """

    spark: SparkSession
    root: str
    period: str
    keys: tuple[str, ...]
    schema: T.StructType

    @staticmethod
    def create(df: DataFrame, root: str, period: str, keys: list[str]) -> PeriodStore:
        """Store `df`, one row for each combination of keys; its other columns are sums and counts."""
        if period not in keys:
            raise ValueError(f"{period} is not one of the keys")
        store = PeriodStore(df.sparkSession, root, period, tuple(keys), df.schema)
        store.log.write(sorted(store._write(df).items()), 0)
        return store

    @property
    def log(self) -> VersionLog:
        return VersionLog(self.spark, f"{self.root}/log", "period string, folder string")

    def folders(self, version: int | None = None) -> dict[str, str]:
        """The folder of each period."""
        log = self.log
        return {row["period"]: row["folder"] for row in log.read(log.newest() if version is None else version)}

    def _name(self, column: str) -> F.Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(_EMPTY))

    def _write(self, df: DataFrame) -> dict[str, str]:
        name = uuid.uuid4().hex
        path = f"{self.root}/data/{name}"
        placed = df.select(*self.schema.names, F.col(self.period).cast("string").alias("period")).repartition("period")
        placed.write.partitionBy("period").parquet(path)
        stored = self.spark.read.schema(T.StructType([T.StructField("period", T.StringType())])).parquet(path)
        found = stored.select(self._name("period")).distinct().collect()
        return {row[0]: f"{name}/period={row[0]}" for row in found}

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/data/{f}" for f in sorted(folders)])

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(list(self.folders(version).values()))

    def _next(self, version: int | None) -> int:
        return (self.log.newest() if version is None else version) + 1

    def add(self, late: DataFrame, version: int | None = None) -> int:
        """Add the sums and counts of rows that came later; only their periods are read and written."""
        number = self._next(version)
        folders = self.folders(number - 1)
        names = [row[0] for row in late.select(self._name(self.period)).distinct().collect()]
        old = self._read([folders[n] for n in names if n in folders])
        sums = [F.sum(c).cast(self.schema[c].dataType).alias(c) for c in self.schema.names if c not in self.keys]
        together = old.unionByName(late.select(*self.schema.names)).groupBy(*self.keys).agg(*sums)
        written = self._write(together.select(*self.schema.names)) if names else {}
        self.log.write(sorted((folders | written).items()), number)
        return number

    def rebuild(self, periods: list, made: Callable[[list], DataFrame], version: int | None = None) -> int:
        """Write some periods anew, from `made(periods)`; a period that has no rows any more goes."""
        number = self._next(version)
        gone = {_EMPTY if p is None else str(p) for p in periods}
        kept = {name: folder for name, folder in self.folders(number - 1).items() if name not in gone}
        self.log.write(sorted((kept | self._write(made(periods))).items()), number)
        return number
