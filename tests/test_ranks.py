import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluate, ranks
from riskloom.operators.ranks import order_statistics, running_totals, smallest_hash_rows
from riskloom.session import materialize


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.fixture
def scored(spark):
    rng = random.Random(3)
    data = []
    for g in ("a", "b"):
        for _ in range(800):
            label = int(rng.random() < 0.3)
            score = round(rng.gauss(0.3 * label, 0.4), 2)
            data.append((g, score, label))
    data += [("a", 0.25, 0)] * 600  # one score holds a third of a group
    return data, spark.createDataFrame(data, "g string, s double, y int")


@pytest.mark.parametrize("ranges", [1, 20])
def test_running_totals_by_window_and_by_range(spark, scored, ranges):
    data, df = scored
    counts = df.groupBy("g", "s").agg(F.count("*").alias("n"))
    got = running_totals(counts, "s", ["n"], ["g"], ranges).collect()
    assert len(got) == counts.count()
    for row in got:
        group = [s for g, s, _ in data if g == row.g]
        assert row.n_before == sum(s < row.s for s in group)
        assert row.n_total == len(group)


def test_running_totals_keep_a_null_group(rows):
    df = rows("g string, v int, n int", ("a", 1, 2), (None, 1, 3), (None, 2, 4))
    for ranges in (100, 1):
        got = {(r.g, r.v): (r.n_before, r.n_total) for r in running_totals(df, "v", ["n"], ["g"], ranges).collect()}
        assert got == {("a", 1): (0, 2), (None, 1): (0, 7), (None, 2): (3, 7)}


@pytest.mark.parametrize("ranges", [1, 20])
def test_auc_with_ties_matches_all_pairs(scored, ranges):
    data, df = scored
    got = {r.g: r for r in evaluate.discrimination(df, "s", "y", ["g"], ranges).collect()}
    for g in ("a", "b"):
        expected = brute_auc([(s, y) for gg, s, y in data if gg == g])
        assert got[g].auc == pytest.approx(expected, abs=1e-12)
        assert got[g].gini == pytest.approx(2 * expected - 1, abs=1e-12)


def test_auc_does_not_change_under_a_monotone_transform(scored):
    _, df = scored
    plain = evaluate.discrimination(df, "s", "y").first()
    bent = evaluate.discrimination(df.withColumn("s", F.exp("s") * 3), "s", "y").first()
    assert plain.auc == bent.auc and plain.ks == bent.ks


def test_one_class_gives_null_and_missing_labels_are_ignored(rows):
    df = rows("s double, y int", (0.1, 1), (0.2, 1), (0.9, None))
    row = evaluate.discrimination(df, "s", "y").first()
    assert (row.n_pos, row.n_neg, row.auc, row.ks) == (2, 0, None, None)


def test_roc_starts_at_the_origin_and_ends_at_one(scored):
    _, df = scored
    curve = evaluate.roc_curve(df, "s", "y").orderBy(F.desc("threshold")).collect()
    assert (curve[0].fpr, curve[0].tpr) == (0.0, 0.0) and curve[0].threshold == float("inf")
    assert (curve[-1].fpr, curve[-1].tpr) == (1.0, 1.0)
    assert all(a.fpr <= b.fpr and a.tpr <= b.tpr for a, b in zip(curve, curve[1:]))
    area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(evaluate.discrimination(df, "s", "y").first().auc, abs=1e-9)


def test_classification_report_by_hand(rows):
    df = rows("y int, p int", (1, 1), (1, 0), (0, 0), (0, 0), (0, 1), (None, 1))
    got = {r["class"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert got["1"].precision == 0.5 and got["1"].recall == 0.5 and got["1"].support == 2
    assert got["0"].precision == pytest.approx(2 / 3) and got["accuracy"].f1 == pytest.approx(0.6)
    assert got["weighted avg"].recall == pytest.approx(0.6) and got["macro avg"].recall == pytest.approx(7 / 12)


def test_univariate_rank_orders_by_strength(spark):
    rng = random.Random(5)
    data = []
    for _ in range(2000):
        y = int(rng.random() < 0.4)
        data.append((y, rng.gauss(-y, 1), rng.gauss(0.3 * y, 1), 1.0, None))
    df = spark.createDataFrame(data, "y int, strong double, weak double, flat double, gone double")
    got = evaluate.univariate_rank(df, ["weak", "flat", "strong", "gone"], "y").collect()
    assert [r.feature for r in got] == ["strong", "weak", "flat", "gone"]
    assert got[2].strength == 0.0


def test_univariate_rank_by_bounds_equals_the_ranking_of_all(spark):
    rng = np.random.default_rng(4)
    n = 6000
    label = (rng.random(n) < 0.2).astype(float)
    columns = {f"f{i}": rng.normal(size=n) * 10.0**i + label * rng.normal() * 10.0**i / 4 for i in range(8)}
    columns |= {f"noise{i}": np.round(rng.random(n), 4) for i in range(30)}
    columns |= {f"whole{i}": rng.integers(0, 5, n).astype(float) for i in range(6)}
    columns |= {"flat": np.full(n, 3.0), "wide": np.where(label == 1, 1e300, -1e300) * rng.random(n), "empty": np.full(n, np.nan)}
    frame = pd.DataFrame(columns)
    frame["same"], frame["y"] = frame["noise3"], label
    frame["huge"] = np.where(np.arange(n) % 9 == 0, np.inf, rng.random(n))
    df = materialize(spark.createDataFrame(frame).withColumn("empty", F.nanvl("empty", F.lit(None).cast("double"))), "bounded")
    features = [c for c in frame.columns if c != "y"]
    filled = frame.fillna(0.0)
    want = sorted(((-round(abs(numpy_auc(filled[f].to_numpy(), label.astype(int))[0] - 0.5), 12), f) for f in features))[:12]
    got = evaluate.univariate_rank(df, features, "y", 12).collect()
    assert [r.feature for r in got] == [f for _, f in want]
    assert all(r.strength == pytest.approx(-s, abs=1e-12) for r, (s, _) in zip(got, want))
    bounds = {features[r.number]: r for r in evaluate.strength_bounds(df, features, "y").collect()}
    for f in features:
        strength = abs(numpy_auc(filled[f].to_numpy(), label.astype(int))[0] - 0.5)
        assert bounds[f].low - 1e-12 <= strength <= bounds[f].high + 1e-12
    assert all(bounds[f].low == bounds[f].high for f in features if f.startswith("whole"))
    # Most features that tell nothing are ruled out by their bounds.
    last = sorted((b.low for b in bounds.values()), reverse=True)[11]
    assert sum(b.high >= last for b in bounds.values()) < len(features) / 2


def test_univariate_rank_with_one_class_scores_nothing(rows):
    got = evaluate.univariate_rank(rows("a double, b double, y int", (1.0, 2.0, 1), (3.0, 4.0, 1), (5.0, 5.0, None)), ["b", "a"], "y").collect()
    assert [(r.feature, r.strength) for r in got] == [("a", 0.0), ("b", 0.0)]


def nearest(values, p):
    ordered = sorted(values)
    return ordered[round(p / 100 * (len(ordered) - 1))]


@pytest.mark.parametrize("n", [1, 2, 5, 101, 400])
@pytest.mark.parametrize("ranges", [1, 30])
def test_nearest_rank_percentiles_and_median(spark, n, ranges):
    rng = random.Random(n)
    values = [round(rng.expovariate(1), 2) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    row = order_statistics(df, "v", {"p50": 50, "p95": 95, "p99": 99}, ranges=ranges).first()
    assert [row.p50, row.p95, row.p99] == [nearest(values, p) for p in (50, 95, 99)]
    middle = sorted(values)[(n - 1) // 2], sorted(values)[n // 2]
    assert row.n == n and row.median == pytest.approx(sum(middle) / 2)


def test_exact_sample_size_and_independence_of_partitioning(spark):
    df = spark.range(5000)
    first = smallest_hash_rows(df, "id", "s", n=1234)
    assert first.count() == 1234
    again = smallest_hash_rows(df.repartition(13), "id", "s", n=1234)
    assert sorted(first.collect()) == sorted(again.collect())
    assert smallest_hash_rows(df, "id", "s", n=9999).count() == 5000
    assert smallest_hash_rows(df, "id", "s", n=0).count() == 0


def test_sample_does_not_depend_on_its_buckets(spark):
    df = spark.range(3000)
    want = sorted(smallest_hash_rows(df, "id", "s", n=1500).collect())
    assert len(want) == 1500
    for bits in (1, 5, 32):
        assert sorted(smallest_hash_rows(df, "id", "s", n=1500, bits=bits).collect()) == want


def test_the_plan_of_a_sample_is_built_without_a_job(spark):
    context = spark.sparkContext
    context.setJobGroup("plans", "none may start")
    smallest_hash_rows(spark.range(100), "id", "s", n=10)
    assert len(context.statusTracker().getJobIdsForGroup("plans")) == 0
    context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("small", [True, False])
def test_a_sample_of_five_thousand_strata_is_exact(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(ranks, "broadcast_if_small", lambda df: df)
    # Strata of 1 to 9 rows, one with a third of all rows, and one without a value.
    sizes = {i: 1 + i % 9 for i in range(5000)}
    df = spark.range(5000).select(F.explode(F.expr("sequence(1, 1 + id % 9)")), F.col("id").alias("y")).drop("col")
    hot = spark.range(12_000).select(F.lit(-1).cast("long").alias("y"))
    none = spark.range(31).select(F.lit(None).cast("long").alias("y"))
    rows = df.unionByName(hot).unionByName(none).withColumn("id", F.monotonically_increasing_id())
    rows = materialize(rows, "strata")
    got = smallest_hash_rows(rows, "id", "s", strata="y", fraction=0.5)
    counts = {r.y: r["count"] for r in got.groupBy("y").count().collect()}
    half = lambda n: (n + 1) // 2  # noqa: E731  0.5 rounds up
    assert counts == {y: half(n) for y, n in (sizes | {-1: 12_000, None: 31}).items()}
    assert got.columns == rows.columns


def numpy_auc(score, label):
    """AUC with ties counted half, KS, by sorting."""
    values, at = np.unique(score, return_inverse=True)
    pos = np.bincount(at, label, len(values))
    neg = np.bincount(at, 1 - label, len(values))
    won = (pos * (np.cumsum(neg) - neg / 2)).sum()
    gap = np.abs(np.cumsum(pos) / pos.sum() - np.cumsum(neg) / neg.sum()).max()
    return won / (pos.sum() * neg.sum()), gap


@pytest.fixture(scope="module")
def many(spark):
    """400,000 rows, nearly all scores distinct, in a large group, a NULL group and small ones."""
    rng = np.random.default_rng(11)
    n = 400_000
    score = np.round(rng.normal(size=n), 6)
    label = (rng.random(n) < 0.3).astype(int)
    group = np.where(np.arange(n) % 2 == 0, 0, np.where(np.arange(n) % 5 == 0, -1, 1 + np.arange(n) % 7))
    frame = pd.DataFrame({"g": group, "s": score, "y": label})
    df = spark.createDataFrame(frame).withColumn("g", F.nullif("g", F.lit(-1)))
    return frame, materialize(df, "many-scores")


@pytest.mark.parametrize("ranges", [None, 1, 8, 64, 500])
def test_many_distinct_values_equal_numpy_for_any_ranges(many, ranges):
    frame, df = many
    auc, ks = numpy_auc(frame.s.to_numpy(), frame.y.to_numpy())
    got = evaluate.discrimination(df, "s", "y", ranges=ranges).first()
    assert got.auc == pytest.approx(auc, abs=1e-13) and got.ks == pytest.approx(ks, abs=1e-13)
    row = order_statistics(df, "s", {"p50": 50, "p95": 95, "p99": 99}, ranges=ranges).first()
    assert [row.p50, row.p95, row.p99] == [nearest(frame.s.tolist(), p) for p in (50, 95, 99)]
    assert row.median == pytest.approx(float(np.median(frame.s)), abs=1e-15)


@pytest.mark.parametrize("ranges", [None, 64])
def test_groups_of_many_distinct_values_equal_numpy(spark, many, ranges):
    frame, df = many
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.g: r for r in evaluate.discrimination(df, "s", "y", ["g"], ranges).collect()}
        mid = {r.g: r for r in order_statistics(df, "s", {"p95": 95}, ["g"], ranges).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(got) == set(mid) == {None if g == -1 else g for g in frame.g.unique()}
    for g, part in frame.groupby("g"):
        g = None if g == -1 else g
        auc, ks = numpy_auc(part.s.to_numpy(), part.y.to_numpy())
        assert got[g].auc == pytest.approx(auc, abs=1e-13) and got[g].ks == pytest.approx(ks, abs=1e-13)
        assert mid[g].p95 == nearest(part.s.tolist(), 95) and mid[g].median == pytest.approx(float(part.s.median()))


def test_one_large_group_spreads_evenly(spark, many):
    frame, df = many
    placed = running_totals(ranks.value_counts(df, "s", []), "s", ["n"], [], 16)
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    stored = spark.read.parquet(re.search(r"(file:\S*|/\S*)ranged-[0-9a-f]+", placed.inputFiles()[0])[0])
    sizes = [r["count"] for r in stored.groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.5 * sum(sizes) / 16
    assert "Join" not in plan


def test_stratified_sample_keeps_the_proportions(spark):
    df = spark.range(4000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    kept = smallest_hash_rows(df, "id", "s", strata="y", fraction=0.7)
    assert {r.y: r["count"] for r in kept.groupBy("y").count().collect()} == {0: 2520, 1: 280}


def test_hash_split_is_complete_and_disjoint(spark):
    df = spark.range(10000)
    left, right = ranks.hash_split(df, "id", 0.75, "x")
    assert left.count() + right.count() == 10000 and left.intersect(right).count() == 0
    assert abs(left.count() - 7500) < 200
