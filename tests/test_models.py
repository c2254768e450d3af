import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators import evaluate, ranks
from riskloom.operators.stepwise import best_candidate, fit_logistic, forward_selection
from riskloom.plans import training
from riskloom.registry.model_queries import beats_chance
from riskloom.sources.synthetic import generate_subjects

FEATURES = ["max_dpd_12m", "credit_utilization", "kol_status", "num_inquiries_12m", "age", "dependents",
            "monthly_income", "num_late_pmt_12m"]


@pytest.fixture(scope="module")
def subjects(spark):
    df = generate_subjects(spark, 6000).select(
        "subject_id", "default_flag", "pd_true", *[F.col(f).cast("double").alias(f) for f in FEATURES]
    )
    return df.repartition(4).cache()


def test_fit_is_at_the_least_penalised_loss(spark):
    rng = random.Random(2)
    data = []
    for _ in range(800):
        x = [rng.gauss(0, 1) for _ in range(2)]
        data.append((int(rng.random() < 1 / (1 + np.exp(-(x[0] - 0.5 * x[1] - 1)))), *x))
    df = spark.createDataFrame(data, "y int, a double, b double").repartition(5)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(df)
    model = fit_logistic(rows, "f", "y", 800)
    table = np.array(data, float)
    design = np.column_stack([np.ones(800), table[:, 1:]])
    weights = np.array([model.intercept, *model.coefficients])
    slope = design.T @ (1 / (1 + np.exp(-design @ weights)) - table[:, 0]) + np.array([0, 1, 1]) * weights
    assert np.abs(slope).max() < 0.01
    with pytest.raises(ArithmeticError):
        fit_logistic(rows, "f", "y", 800, max_iter=1)


def test_a_later_candidate_must_be_clearly_better():
    assert best_candidate([(4, 0.70), (1, 0.70009), (2, 0.69)], 0.5) == 4
    assert best_candidate([(4, 0.70), (1, 0.70011), (2, 0.69)], 0.5) == 1
    assert best_candidate([(4, 0.70), (1, None)], 0.69995) is None
    assert best_candidate([], 0.5) is None


def test_forward_selection_improves_every_round(subjects):
    fit, validate = ranks.hash_split(subjects, "subject_id", 0.7, "t")
    steps = forward_selection(fit, validate, FEATURES, "default_flag", max_rounds=3)
    assert len(steps) == 3
    aucs = [0.5] + [s.auc for s in steps]
    assert all(b > a + 1e-4 for a, b in zip(aucs, aucs[1:]))
    first = evaluate.univariate_rank(validate, FEATURES, "default_flag").collect()[0]
    assert steps[0].auc == pytest.approx(0.5 + first.strength, abs=0.02)


def test_models_beat_chance_and_stay_below_the_truth(spark, subjects, tmp_path):
    train, test = ranks.hash_split(subjects, "subject_id", 0.75, "split")
    logreg, steps = training.train_logreg_stepwise(
        train, FEATURES, "subject_id", "default_flag", sample=2000, max_rounds=3
    )
    models = {
        "logreg": logreg,
        "weighted": training.train_gbt_weighted(train, FEATURES, "default_flag", trees=5),
        "balanced": training.train_gbt_balanced(train, FEATURES, "default_flag", trees=5),
    }
    table = training.model_comparison(models, test, "default_flag").collect()
    truth = evaluate.discrimination(test, "pd_true", "default_flag").first().auc
    assert [r.auc for r in table] == sorted((r.auc for r in table), reverse=True)
    assert all(0.55 < r.auc < truth + 0.03 and r.gini == pytest.approx(2 * r.auc - 1) for r in table)
    curves = training.model_curves(models, test, "default_flag")
    assert {r.model for r in curves.select("model").distinct().collect()} == set(models)
    training.save_model(models["logreg"], spark.createDataFrame(table), str(tmp_path), "PD", "V1")
    loaded, metrics = training.load_model(spark, str(tmp_path), "PD", "V1")
    assert training.best_model(metrics.orderBy(F.desc("auc"))) == table[0].model
    a = training.positive_probability(models["logreg"], test).agg(F.sum("score")).first()[0]
    assert training.positive_probability(loaded, test).agg(F.sum("score")).first()[0] == pytest.approx(a)
    assert len(steps) >= 1


def test_scores_that_tell_nothing_do_not_beat_chance(spark, subjects):
    scored = subjects.withColumn("score", F.col("pd_true"))
    assert beats_chance(scored)
    assert not beats_chance(scored.withColumn("score", F.lit(0.3)))
    assert not beats_chance(scored.withColumn("score", F.abs(F.xxhash64("subject_id")).cast("double")))
    assert not beats_chance(scored.withColumn("score", 1 - F.col("score")))
    # With few rows of a class nothing is asked.
    assert beats_chance(scored.withColumn("score", F.lit(0.3)).limit(30))
