"""Session construction and the durable scratch area."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on; a cluster supplies `master` itself."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Call sites of column expressions are not recorded: wide plans build three times as fast.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`, else one below the warehouse.

    Executors of a cluster must reach it. A folder named in `spark.checkpoint.dir` is taken as it is, as it may be
    mounted on all machines; a warehouse on the driver's own disk, which is Spark's default, is refused
    unless the executors run there, too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    check_shared(warehouse, spark.sparkContext.master)
    return f"{warehouse}/_scratch"


def check_shared(folder: str, master: str) -> None:
    """Raise if executors of a cluster cannot reach a folder."""
    if not master.startswith("local") and (folder.startswith("file:") or "://" not in folder and folder.startswith("/")):
        raise ValueError(f"{folder} is a folder of one machine; set spark.checkpoint.dir to one that all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; never reused, so nothing has to be cleared."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and return the written table.

    Used where a result is read several times and must not be recomputed differently, or where the
    lineage should end; the files outlive any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
