"""Numbered versions of a table: small lists of rows under fresh names, never changed once written."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Row, SparkSession


@dataclass(frozen=True)
class VersionLog:
    """What belongs to each version of a table, one folder of rows per version below `root`.

    A version counts once it is finished (Spark's _SUCCESS file); a write that failed leaves nothing that is
    read. There is one writer at a time. A version that is written again after a failure has equal
    entries under two names, of which the first in order counts.
    """

    spark: SparkSession
    root: str
    schema: str
    _known: dict[int, list[Row]] = field(default_factory=dict, repr=False, compare=False)

    def _names(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(f.getPath().getParent().getName() for f in found or [])

    def newest(self) -> int | None:
        names = self._names()
        return int(names[-1].split("-")[0]) if names else None

    def read(self, version: int) -> list[Row]:
        if version not in self._known:
            name = next(n for n in self._names() if int(n.split("-")[0]) == version)
            self._known[version] = self.spark.read.schema(self.schema).parquet(f"{self.root}/{name}").collect()
        return self._known[version]

    def write(self, rows: list[tuple], version: int) -> None:
        entries = self.spark.createDataFrame(rows, self.schema).coalesce(1)
        entries.write.parquet(f"{self.root}/{version:010d}-{uuid.uuid4().hex}")
        self._known[version] = entries.collect() if not rows else [Row(*entries.columns)(*r) for r in rows]
