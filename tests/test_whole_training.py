"""Models are fitted on all training rows, however many there are."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import stepwise
from riskloom.plans import training
from riskloom.registry import model_queries


def run_over(rows):
    class Run(model_queries.ModelRun):
        def __init__(self):
            self.train = rows

    return Run()


def test_boosted_models_read_every_training_row(spark):
    many = spark.range(1_000_300).select(F.col("id").alias("subject_id"))
    assert run_over(many).boosted_rows.agg(F.count("subject_id"), F.sum("subject_id")).first() == many.agg(
        F.count("subject_id"), F.sum("subject_id")
    ).first()
    # Keys that are missing or repeat are rows like any other.
    odd = spark.createDataFrame([(None,), (1,), (1,)], "subject_id bigint")
    assert sorted(run_over(odd).boosted_rows.collect(), key=str) == sorted(odd.collect(), key=str)


@pytest.fixture(scope="module")
def many(spark):
    """More rows than fit a bounded sample, with one feature that tells something about the label."""
    a = (F.col("id") % 101) / 50.0 - 1
    label = (F.col("id") * 37 % 100 < 40 + 30 * a).cast("int")
    return spark.range(100_400).select(F.col("id").alias("subject_id"), label.alias("default_flag"), a.alias("a")).cache()


def test_the_logistic_model_is_chosen_and_fitted_on_every_training_row(many, monkeypatch):
    read, rank, select, fit = {}, training.univariate_rank, training.forward_selection, training.fit_logistic

    def ranked(rows, *rest):
        read["ranked"] = rows.count()
        return rank(rows, *rest)

    def selected(chosen_on, validated_on, *rest):
        read["chosen or validated"] = chosen_on.count() + validated_on.count()
        return select(chosen_on, validated_on, *rest)

    def fitted(rows, features, label, n, **rest):
        read["fitted"], read["weighed"] = rows.count(), n
        return fit(rows, features, label, n, **rest)

    for name, spy in (("univariate_rank", ranked), ("forward_selection", selected), ("fit_logistic", fitted)):
        monkeypatch.setattr(training, name, spy)
    model, steps = training.train_logreg_stepwise(many, ["a"], "subject_id", "default_flag")
    assert read == dict.fromkeys(["ranked", "chosen or validated", "fitted", "weighed"], 100_400)
    assert [s.feature for s in steps] == ["a"]
    assert training.logistic_slope(model, many, "default_flag") < 1e-4


def test_the_optimum_is_checked_on_every_training_row(many, monkeypatch):
    run, read, slope = run_over(many), [], training.logistic_slope
    run.test, run.numeric = many.where("subject_id % 50 = 0"), ["a"]

    def checked(model, rows, label):
        read.append(rows.count())
        return slope(model, rows, label)

    monkeypatch.setattr(training, "logistic_slope", checked)
    monkeypatch.setattr(model_queries, "model_run", lambda t: run)
    found = model_queries.train_logreg_stepwise(None)
    assert read == [100_400]
    assert found.where("at_optimum AND gains_hold AND above_chance").count() == run.test.count()


def test_the_rows_of_many_tasks_are_summed_in_few(spark, monkeypatch):
    rows = [(i, int(i * 37 % 100 < 40 + 30 * ((i % 101) / 50 - 1)), (i % 101) / 50 - 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, y int, a double")
    steps = [stepwise.forward_selection(df, df, ["a"], "y")]
    for least, most in ((1000, 10_000), (10, 100), (10, 10)):
        monkeypatch.setattr(stepwise, "ROWS_PER_TASK", least)
        monkeypatch.setattr(stepwise, "MOST_ROWS_PER_TASK", most)
        steps.append(stepwise.forward_selection(df, df, ["a"], "y"))
    assert [s.feature for s in steps[0]] == ["a"] and steps.count(steps[0]) == len(steps)


def test_the_compared_models_are_given_every_training_row(spark, monkeypatch):
    rows = spark.range(1_000_300).select(F.col("id").alias("subject_id"))
    run = run_over(rows)
    run.inputs = run.numeric = []
    # No argument beyond these: none that asks for fewer rows.
    monkeypatch.setattr(training, "train_logreg_stepwise", lambda train, numeric, id_, label: (train.count(), []))
    for kind in ("weighted", "balanced"):
        monkeypatch.setattr(training, f"train_gbt_{kind}", lambda train, features, label: train.count())
    assert run.models == dict.fromkeys(["LogReg (stepwise)", "GBT (weighted)", "GBT (balanced)"], 1_000_300)
