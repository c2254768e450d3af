"""Decision requests, drift and feature refresh as Structured Streaming jobs.

Each job hands its micro-batches to the batch operators and writes them under the batch number, so a
batch that is run again after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as c
from riskloom.operators.drift import outcome_counts, overall_means, performance_of_counts, with_baseline
from riskloom.operators.joins import is_small, left_join_lookups
from riskloom.operators.upserts import BUCKET_ROWS, BucketedTable
from riskloom.session import materialize, scratch_path
from riskloom.sources.periods import PeriodStore


def table_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stored_folder(table: DataFrame) -> str:
    """The folder of a table that was written by one job."""
    return table.inputFiles()[0].rsplit("/", 1)[0]


def run_available(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Process everything that is there now, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def score_requests(
    requests: DataFrame, features: DataFrame | BucketedTable, key: str, row_key: str, pd: Column, version: int | None = None
) -> DataFrame:
    """Requests with probability, score and decision; an unknown subject has none of them.

    Of features in a bucketed table only the buckets of the requested subjects are read. Other features
    are cut to the subjects of the requests: a batch has few of them, so they are sent to the scan of
    the features, which are not shuffled; only a batch of very many subjects makes Spark join both
    sides by a shuffle.
    """
    wanted = requests.select(key).distinct()
    small = is_small(wanted)
    if isinstance(features, BucketedTable):
        known = features.lookup(wanted, version)
    else:
        known = features.join(F.broadcast(wanted) if small else wanted, key, "left_semi")
    probable = known.withColumn("pd_probability", pd).select(key, "pd_probability")
    # Of each wanted subject one row is known, so that this side is as small as the other.
    if small:
        joined = requests.join(F.broadcast(probable), key, "left")
    else:
        joined = left_join_lookups(requests, [probable], key, row_key)
    found = F.col("pd_probability")
    return joined.select(
        *requests.columns,
        "pd_probability",
        c.credit_score(found).alias("credit_score"),
        F.when(found.isNotNull(), c.decision_band(found)).alias("decision"),
    )


def stream_score(
    requests: DataFrame,
    features: DataFrame | BucketedTable,
    key: str,
    row_key: str,
    pd: Column,
    checkpoint: str,
    sink: str,
) -> DataFrame:
    """Score a stream of requests into a log and return the log.

    A bucketed table is read as it is when a batch starts, so that requests see refreshed features.
    """

    def each(batch: DataFrame, number: int) -> None:
        scored = score_requests(batch, features, key, row_key, pd)
        scored.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    run_available(requests, each, checkpoint)
    spark = features.spark if isinstance(features, BucketedTable) else features.sparkSession
    return spark.read.option("basePath", sink).parquet(sink).drop("batch")


def stream_drift(
    rows: DataFrame,
    baseline: DataFrame,
    at: str,
    feature: str,
    checkpoint: str,
    sink: str,
    lateness: str = "1 day",
) -> DataFrame:
    """Daily mean of a column as it arrives, and its difference from the baseline mean.

    State is one row per open day. Days updated by a batch are written with it; the newest entry of
    a day counts. Rows later than `lateness` behind the newest row are dropped.
    """
    daily = (
        rows.withColumn("_at", F.col(at).cast("timestamp"))
        .withWatermark("_at", lateness)
        .groupBy(F.window("_at", "1 day").alias("w"))
        .agg(F.avg(feature).alias("mean"), F.count(feature).alias("n"))
        .select(F.col("w.start").cast("date").alias("day"), "mean", "n")
    )

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    run_available(daily, each, checkpoint, "update")
    written = baseline.sparkSession.read.option("basePath", sink).parquet(sink)
    newest = written.groupBy("day").agg(F.max_by(F.struct("mean", "n"), "batch").alias("s"))
    current = newest.select("day", F.lit(feature).alias("feature"), "s.mean", "s.n")
    return with_baseline(current, overall_means(baseline, [feature]))


def stream_performance(
    predictions: DataFrame,
    outcomes: DataFrame,
    key: str,
    predicted_at: str,
    known_at: str,
    score: str,
    label: str,
    checkpoint: str,
    store: str,
    horizon: str = "30 days",
    lateness: str = "1 day",
    threshold: float = 0.5,
) -> DataFrame:
    """Accuracy and AUC per day of prediction, corrected whenever outcomes come in.

    Both streams are joined on `key` as far as an outcome is known within `horizon` of its prediction;
    rows later than `lateness` behind the newest of their stream are dropped, so that state holds one
    horizon of predictions and one lateness of outcomes. A batch adds its outcomes to the stored counts
    per day and score, of which only the days it touches are written; version n + 1 of the counts is
    made from version n by batch n, so running a batch again gives the same version again.
    """
    spark = predictions.sparkSession
    made = predictions.select(
        key, F.col(predicted_at).cast("timestamp").alias("_predicted"), F.col(score).alias("_score")
    ).withWatermark("_predicted", lateness)
    known = outcomes.select(
        F.col(key).alias("_key"), F.col(known_at).cast("timestamp").alias("_known"), F.col(label).alias("_label")
    ).withWatermark("_known", lateness)
    within = F.expr(f"_known BETWEEN _predicted AND _predicted + INTERVAL {horizon}")
    joined = made.join(known, (F.col(key) == F.col("_key")) & within)

    def counted(rows: DataFrame) -> DataFrame:
        return outcome_counts(rows, "_predicted", "_score", "_label")

    kind = f"_predicted timestamp, _score {predictions.schema[score].dataType.simpleString()}, _label int"
    counts = PeriodStore.create(counted(spark.createDataFrame([], kind)), store, "day", ["day", "score"])

    def each(batch: DataFrame, number: int) -> None:
        counts.add(materialize(counted(batch), "outcomes"), number)

    run_available(joined, each, checkpoint)
    return performance_of_counts(counts.read(), threshold)


def stream_feature_refresh(
    changes: DataFrame,
    summarise: Callable[[DataFrame], DataFrame],
    base: DataFrame,
    key: str,
    increments: tuple[str, ...],
    checkpoint: str,
    versions: str,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Apply a stream of raw changes to a feature table, one table version per micro-batch.

    `summarise` reduces a batch to one row per key. A batch reads and writes only the key buckets that
    it touches. Version n + 1 is made from version n by batch n, so running a batch again gives the
    same version again.
    """
    table = BucketedTable.create(base, versions, key, bucket_rows)

    def each(batch: DataFrame, number: int) -> None:
        table.upsert(summarise(batch), increments, number)

    run_available(changes, each, checkpoint)
    return table.read()


def stream_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh checkpoint and output folders for one run."""
    return scratch_path(spark, f"{name}-state"), scratch_path(spark, f"{name}-out")
