"""Drift and performance of a scored population over daily windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.evaluate import discrimination_of_counts, score_counts
from riskloom.session import materialize


def in_period(df: DataFrame, at: str, as_of: dt.date, days: int = 30) -> DataFrame:
    """Rows of the days as_of - days .. as_of, both included."""
    first = F.date_sub(F.lit(as_of), days).cast("timestamp_ntz")
    after = F.date_add(F.lit(as_of), 1).cast("timestamp_ntz")
    return df.where((F.col(at) >= first) & (F.col(at) < after))


def daily_means(df: DataFrame, at: str, features: list[str]) -> DataFrame:
    """Mean and count per day and feature: one aggregate over the rows, then a small unpivot."""
    per_day = df.groupBy(F.col(at).cast("date").alias("day")).agg(
        *[F.struct(F.avg(f).alias("mean"), F.count(f).alias("n")).alias(f) for f in features]
    )
    return per_day.unpivot(["day"], features, "feature", "s").select(
        "day", "feature", F.col("s.mean").alias("mean"), F.col("s.n").alias("n")
    )


def overall_means(df: DataFrame, features: list[str]) -> DataFrame:
    """Mean per feature, one row each."""
    means = df.agg(*[F.avg(f).alias(f) for f in features])
    return means.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(f).alias("feature"), F.col(f).alias("baseline_mean")) for f in features]
            )
        )
    )


def difference_of_means(
    source: DataFrame,
    baseline: DataFrame,
    at: str,
    features: list[str],
    as_of: dt.date,
    days: int = 30,
) -> DataFrame:
    """Per day and feature: mean(source) - mean(baseline), for the days that have source rows."""
    daily = daily_means(in_period(source, at, as_of, days), at, features)
    return with_baseline(daily, overall_means(baseline, features))


def with_baseline(daily: DataFrame, baseline_means: DataFrame) -> DataFrame:
    """The baseline holds one row per named feature, so it is small by construction."""
    return daily.join(F.broadcast(baseline_means), "feature").select(
        "day", "feature", "n", "mean", "baseline_mean",
        (F.col("mean") - F.col("baseline_mean")).alias("difference"),
    )


def outcome_counts(predictions: DataFrame, at: str, score: str, label: str) -> DataFrame:
    """Positive and negative outcomes per day and score, of the rows whose outcome is known; they add up."""
    daily = predictions.select(F.col(at).cast("date").alias("day"), F.col(score).alias("score"), F.col(label).alias("label"))
    return score_counts(daily, "score", "label", ["day"])


def performance_of_counts(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy and AUC per day from the counts of its outcomes."""
    n, hits = F.col("pos") + F.col("neg"), F.when(F.col("score") >= threshold, F.col("pos")).otherwise(F.col("neg"))
    accuracy = counts.groupBy("day").agg(F.sum(n).alias("n"), F.try_divide(F.sum(hits).cast("double"), F.sum(n)).alias("accuracy"))
    ranked = discrimination_of_counts(counts, "score", ["day"]).select(F.col("day").alias("_day"), "auc")
    return accuracy.join(ranked, F.col("day").eqNullSafe(F.col("_day"))).drop("_day")


def performance_by_day(
    predictions: DataFrame, at: str, score: str, label: str, threshold: float = 0.5
) -> DataFrame:
    """Accuracy and AUC per day over the rows whose outcome is known.

    Rows are reduced once to counts per day and score, which both numbers are made of.
    """
    counts = materialize(outcome_counts(predictions, at, score, label), "outcome-counts")
    return performance_of_counts(counts, threshold)
