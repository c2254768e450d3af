"""Classifier evaluation as aggregates and ordered running totals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskloom.operators.ranks import running_totals


def score_counts(df: DataFrame, score: str, label: str, groups: list[str]) -> DataFrame:
    """Positives and negatives per group and distinct score; unlabelled or unscored rows are left out."""
    return (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*groups, score)
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) != 1).alias("neg"),
        )
    )


def _placed(
    df: DataFrame, score: str, label: str, groups: list[str], ranges: int | None
) -> DataFrame:
    return running_totals(score_counts(df, score, label, groups), score, ["pos", "neg"], groups, ranges)


def discrimination(
    df: DataFrame,
    score: str,
    label: str,
    groups: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Exact AUC (ties count half), Gini and KS per group; NULL where only one class occurs."""
    groups = groups or []
    return discrimination_of_counts(score_counts(df, score, label, groups), score, groups, ranges)


def discrimination_of_counts(
    counts: DataFrame, score: str, groups: list[str], ranges: int | None = None
) -> DataFrame:
    """The same from `pos` and `neg` per group and distinct score."""
    placed = running_totals(counts, score, ["pos", "neg"], groups, ranges)
    pos, neg = F.col("pos"), F.col("neg")
    won = pos * (F.col("neg_before") + neg / 2.0)
    gap = F.abs(
        F.try_divide((F.col("pos_before") + pos).cast("double"), F.col("pos_total"))
        - F.try_divide((F.col("neg_before") + neg).cast("double"), F.col("neg_total"))
    )
    stats = placed.groupBy(*groups).agg(
        F.sum(won).alias("_won"),
        F.sum(pos).alias("n_pos"),
        F.sum(neg).alias("n_neg"),
        F.max(gap).alias("ks"),
    )
    auc = F.try_divide(F.col("_won"), F.col("n_pos").cast("double") * F.col("n_neg"))
    return stats.select(
        *groups, "n_pos", "n_neg", auc.alias("auc"), (2 * auc - 1).alias("gini"), "ks"
    )


def roc_curve(
    df: DataFrame,
    score: str,
    label: str,
    groups: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, and the origin at an infinite threshold."""
    groups = groups or []
    placed = _placed(df, score, label, groups, ranges)
    points = placed.select(
        *groups,
        F.col(score).cast("double").alias("threshold"),
        F.try_divide((F.col("neg_total") - F.col("neg_before")).cast("double"), F.col("neg_total"))
        .alias("fpr"),
        F.try_divide((F.col("pos_total") - F.col("pos_before")).cast("double"), F.col("pos_total"))
        .alias("tpr"),
    )
    origin = placed.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(
        *groups,
        F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def roc_long(curves: dict[str, DataFrame]) -> DataFrame:
    """Several ROC curves below each other with a model column."""
    named = [curve.withColumn("model", F.lit(name)) for name, curve in curves.items()]
    out = named[0]
    for curve in named[1:]:
        out = out.unionByName(curve)
    return out


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_report(
    df: DataFrame, label: str, prediction: str, classes: tuple[int, ...] = (0, 1)
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    One aggregation to a single row of counts; the rest is arithmetic on that row.
    """
    actual, predicted = F.col(label), F.col(prediction)
    counts = df.where(actual.isNotNull() & predicted.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(actual == predicted).alias("hits"),
        *[F.count_if((actual == k) & (predicted == k)).alias(f"tp_{k}") for k in classes],
        *[F.count_if(predicted == k).alias(f"pp_{k}") for k in classes],
        *[F.count_if(actual == k).alias(f"support_{k}") for k in classes],
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    per_class = {}
    for k in classes:
        precision = ratio(F.col(f"tp_{k}"), F.col(f"pp_{k}"))
        recall = ratio(F.col(f"tp_{k}"), F.col(f"support_{k}"))
        f1 = ratio(2 * F.col(f"tp_{k}"), F.col(f"pp_{k}") + F.col(f"support_{k}"))
        per_class[k] = (precision, recall, f1)

    def mean(i: int) -> Column:
        return sum((per_class[k][i] for k in classes), F.lit(0.0)) / len(classes)

    def weighted(i: int) -> Column:
        parts = (per_class[k][i] * F.col(f"support_{k}") for k in classes)
        return ratio(sum(parts, F.lit(0.0)), F.col("n"))

    accuracy = ratio(F.col("hits"), F.col("n"))
    rows = [row(str(k), *per_class[k], F.col(f"support_{k}")) for k in classes]
    rows.append(row("accuracy", accuracy, accuracy, accuracy, F.col("n")))
    rows.append(row("macro avg", mean(0), mean(1), mean(2), F.col("n")))
    rows.append(row("weighted avg", weighted(0), weighted(1), weighted(2), F.col("n")))
    return counts.select(F.inline(F.array(*rows)))


def _numbers(features: list[str]) -> list[str]:
    """SQL text of the features as doubles, NULL as 0."""
    return [f"coalesce(cast(`{f}` AS DOUBLE), 0D)" for f in features]


def strength_bounds(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Least and greatest |AUC - 0.5| that counts in bins allow each feature: number, low, high.

    One pass finds the features' ranges, another counts classes in equal bins of them, combined in the
    tasks. Pairs in one bin are undecided, unless the bin holds a single value. Bins are as many as
    four times the root of the rows: the AUCs of features that tell nothing lie closer together with more
    rows, and the bins follow.
    """
    values = _numbers(features)
    known = df.where(F.col(label).isNotNull())
    long = known.select(F.posexplode(F.expr(f"array({', '.join(values)})")).alias("number", "v"))
    limits = {r.number: r for r in long.groupBy("number").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n")).collect()}
    n_bins = max(2, math.ceil(4 * math.sqrt(max((r.n for r in limits.values()), default=0))))

    # A bin is a monotone function of the value, whatever is rounded; without a finite range there is one bin.
    ranges = [(limits[i].lo, limits[i].hi) if i in limits else (0.0, 0.0) for i in range(len(features))]
    wide = [hi > lo and hi - lo > 1e-300 and math.isfinite(hi - lo) for lo, hi in ranges]
    lows = ", ".join(f"{lo!r}D" if ok else "0D" for (lo, _), ok in zip(ranges, wide))
    scales = ", ".join(f"{n_bins / (hi - lo)!r}D" if ok else "0D" for (lo, hi), ok in zip(ranges, wide))
    placed = known.select(F.col(label).alias("_label"), F.posexplode(F.expr(f"array({', '.join(values)})")).alias("number", "v"))
    limited = placed.select(
        "_label", "number", "v", F.expr(f"array({lows})[number]").alias("_low"), F.expr(f"array({scales})[number]").alias("_scale")
    )
    bin_of = F.when(F.col("_scale") > 0, F.floor((F.col("v") - F.col("_low")) * F.col("_scale"))).otherwise(F.lit(0).cast("bigint"))
    counts = limited.groupBy("number", bin_of.alias("bin")).agg(
        F.count_if(F.col("_label") == 1).alias("pos"),
        F.count_if(F.col("_label") != 1).alias("neg"),
        (F.min("v") == F.max("v")).alias("one_value"),
    )
    earlier = W.partitionBy("number").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    won = F.col("pos") * F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    open_pairs = F.col("pos") * F.col("neg")
    decided = counts.select(
        "number", "pos", "neg",
        (won + F.when(F.col("one_value"), open_pairs / 2).otherwise(0)).alias("least"),
        (won + F.when(F.col("one_value"), open_pairs / 2).otherwise(open_pairs)).alias("most"),
    )
    sums = decided.groupBy("number").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "least", "most")])
    pairs = F.col("pos").cast("double") * F.col("neg")
    least, most = (F.coalesce(F.try_divide(F.col(c), pairs) - 0.5, F.lit(0.0)) for c in ("least", "most"))
    return sums.select(
        "number",
        F.greatest(least, -most, F.lit(0.0)).alias("low"),
        F.greatest(F.abs(least), F.abs(most)).alias("high"),
    )


def univariate_rank(
    df: DataFrame,
    features: list[str],
    label: str,
    keep: int = 30,
    ranges: int | None = None,
) -> DataFrame:
    """|AUC - 0.5| of every feature alone, the `keep` best first; NULL counts as 0.

    Bounds from binned counts rule out the features that cannot be among the best; what the bounds leave
    open is ranked exactly in one job: unpivot, combine per (feature, value), rank inside features.
    A feature on which AUC is undefined scores 0. Features go by their number until the end; the driver
    holds one row for each.
    """
    bounds = {r.number: (r.low, r.high) for r in strength_bounds(df, features, label).collect()}
    bounds = {i: bounds.get(i, (0.0, 0.0)) for i in range(len(features))}
    last = sorted((low for low, _ in bounds.values()), reverse=True)[:keep]
    near = 1e-9  # sums of halves may differ in their last digits, and equal strengths go by name
    able = [i for i, (_, high) in bounds.items() if len(last) < keep or high >= last[-1] - near]
    unsure = [i for i in able if bounds[i][1] - bounds[i][0] > 1e-13]
    names = F.array(*[F.lit(f) for f in features])
    known = [(i, bounds[i][0]) for i in able if i not in unsure]
    found = df.sparkSession.createDataFrame(known, "number int, strength double")
    if unsure:
        values = _numbers([features[i] for i in unsure])
        cells = ", ".join(f"struct({i} AS number, {v} AS value)" for i, v in zip(unsure, values))
        long = df.select(F.col(label).alias("_label"), F.expr(f"inline(array({cells}))"))
        stats = discrimination(long, "value", "_label", ["number"], ranges)
        exact = stats.select("number", F.coalesce(F.abs(F.col("auc") - 0.5), F.lit(0.0)).alias("strength"))
        found = found.unionByName(exact)
    return (
        found.select(names[F.col("number")].alias("feature"), "strength")
        .orderBy(F.desc(F.round("strength", 12)), "feature")
        .limit(keep)
    )
