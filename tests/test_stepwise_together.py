import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators import stepwise


@pytest.fixture(scope="module")
def drawn(spark):
    rng, data = random.Random(5), []
    for i in range(900):
        x = [rng.gauss(0, 1) for _ in range(4)]
        data.append((i, int(rng.random() < 1 / (1 + np.exp(-(x[0] - 0.5 * x[2] - 1)))), *x))
    return spark.createDataFrame(data, "id int, y int, a double, b double, c double, d double").repartition(5).cache()


def test_candidates_fitted_together_are_at_their_optima(drawn):
    train = drawn.select("y", F.array("a", "b", "c", "d").alias("x"))
    candidates = {0: [0], 2: [0, 2], 3: [1, 3, 0]}
    fitted = stepwise.fit_candidates(train, candidates, {i: np.zeros(1 + len(own)) for i, own in candidates.items()})
    table = np.array(drawn.select("y", "a", "b", "c", "d").collect(), float)
    for i, own in candidates.items():
        design = np.column_stack([np.ones(len(table)), table[:, [1 + j for j in own]]])
        slope = design.T @ (1 / (1 + np.exp(-design @ fitted[i])) - table[:, 0]) + np.array([0, *[1] * len(own)]) * fitted[i]
        assert np.abs(slope).max() < 1e-4
        rows = VectorAssembler(inputCols=["abcd"[j] for j in own], outputCol="f").transform(drawn)
        alone = stepwise.fit_logistic(rows, "f", "y", len(table))
        assert [alone.intercept, *alone.coefficients] == pytest.approx(fitted[i], abs=1e-3)
    with pytest.raises(ArithmeticError):
        stepwise.fit_candidates(train, candidates, {i: np.zeros(1 + len(own)) for i, own in candidates.items()}, max_iter=1)


def test_a_step_too_far_is_halved(spark):
    rows = spark.createDataFrame([(int(v > 0), [v / 7.0]) for v in range(-40, 60)], "y int, x array<double>")
    near = stepwise.fit_candidates(rows, {0: [0]}, {0: np.zeros(2)})[0]
    far = stepwise.fit_candidates(rows, {0: [0]}, {0: np.array([-30.0, -9.0])})[0]
    assert np.isfinite(near).all() and near[1] > 1 and far == pytest.approx(near, abs=1e-3)


def test_a_round_fits_no_candidate_on_its_own(drawn, monkeypatch):
    def alone(*_, **__):
        raise AssertionError("a candidate was fitted on its own")

    monkeypatch.setattr(stepwise, "fit_logistic", alone)
    fit, validate = drawn.where("id % 3 != 0"), drawn.where("id % 3 = 0")
    steps = stepwise.forward_selection(fit, validate, ["a", "b", "c", "d"], "y", max_rounds=2)
    assert [s.feature for s in steps] == ["a", "c"]
    assert stepwise.forward_selection(fit.where("y = 1"), validate, ["a", "b"], "y") == []


def test_labels_that_are_missing_raise(drawn):
    broken = drawn.withColumn("y", F.when(F.col("id") != 7, F.col("y")))
    with pytest.raises(ValueError, match="0 or 1"):
        stepwise.forward_selection(broken, drawn, ["a"], "y")
