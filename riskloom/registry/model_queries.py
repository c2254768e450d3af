"""Trained models and streaming jobs as named queries."""

from __future__ import annotations

import datetime as dt
import math
from concurrent.futures import ThreadPoolExecutor
from functools import cache, cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import columns as c
from riskloom.functions import fixed_values as fv
from riskloom.operators import drift, encode, evaluate, ranks
from riskloom.operators.drift import in_period
from riskloom.operators.stepwise import MIN_GAIN
from riskloom.operators.upserts import BucketedTable
from riskloom.plans import mart, training
from riskloom.registry.queries import (
    EVENTS_AS_OF,
    monitor_sets,
    register,
    rounded,
    upsert_inputs,
)
from riskloom.session import materialize, scratch_path
from riskloom.sources import tables
from riskloom.sources.testtables import SCORED_AT, CreditTables
from riskloom.streaming import jobs

LABEL = "default_flag"
BASELINE_AT, SOURCE_AT = "2026-07-01 00:00:00", "2026-07-15 00:00:00"
CLASS_AS_OF = dt.date(2026, 7, 20)
#: Test rows of each class from which on a model has to show that it beats chance.
ENOUGH = 20


class ModelRun:
    """Train and test sets of one data folder and the models fitted on them, each once."""

    def __init__(self, t: CreditTables):
        labels = t.model_inputs.select("subject_id", LABEL, "pd_true")
        encoded = encode.fill_zero(encode.scoring_view(t.model_inputs)).join(labels, "subject_id")
        train, test = ranks.hash_split(encoded, "subject_id", 0.75, "split")
        self.spark = t.spark
        self.train = materialize(train, "model-train")
        self.test = materialize(test, "model-test")
        self.inputs = [n for n in encoded.columns if n not in ("subject_id", LABEL, "pd_true")]
        self.numeric = [n for n in self.inputs if not n.startswith(
            ("gender_", "employment_type_", "education_", "region_code_"))]

    @cached_property
    def boosted_rows(self) -> DataFrame:
        return training.boosted_rows(self.train)

    @cached_property
    def weighted(self) -> PipelineModel:
        return training.train_gbt_weighted(self.boosted_rows, self.inputs, LABEL)

    @cached_property
    def balanced(self) -> PipelineModel:
        return training.train_gbt_balanced(self.boosted_rows, self.inputs, LABEL)

    @cached_property
    def logreg(self) -> tuple[PipelineModel, list]:
        return training.train_logreg_stepwise(self.train, self.numeric, "subject_id", LABEL)

    @cached_property
    def models(self) -> dict[str, PipelineModel]:
        """All models, fitted at the same time: each is a long chain of short jobs, which leave most cores idle."""
        training.with_checkpoints(self.boosted_rows)  # both boosted models read these rows, made before they begin
        with ThreadPoolExecutor(3) as pool:
            fits = [pool.submit(getattr, self, name) for name in ("logreg", "weighted", "balanced")]
            logreg, weighted, balanced = (fit.result() for fit in fits)
        return {"LogReg (stepwise)": logreg[0], "GBT (weighted)": weighted, "GBT (balanced)": balanced}

    @cached_property
    def comparison(self) -> DataFrame:
        found = training.model_comparison(self.models, self.test, LABEL)
        return materialize(found.coalesce(1), "model-comparison")

    @cached_property
    def stored(self) -> str:
        """The folder where the best model is stored with the comparison."""
        root = scratch_path(self.spark, "models")
        best = training.best_model(self.comparison.orderBy(F.desc("auc"), "model"))
        training.save_model(self.models[best], self.comparison, root, "PD_MODEL", mart.MODEL_VERSION)
        return root


@cache
def model_run(t: CreditTables) -> ModelRun:
    return ModelRun(t)


# Fitted numbers cannot be had from SQL. The model queries return the rows that SQL can derive and, for
# each, whether what must hold of the fitted values does.


def _checked(scored: DataFrame, *columns: str) -> DataFrame:
    """Whether a score is a probability, and the class the one that the score stands for."""
    return scored.select(
        *columns,
        F.coalesce(F.col("score").between(0, 1), F.lit(False)).alias("score_in_range"),
        F.coalesce(F.col("prediction") == (F.col("score") > 0.5).cast("int"), F.lit(False)).alias("class_follows"),
    )


def _noise(n_pos: int, n_neg: int) -> float:
    """One standard deviation of the AUC of scores that tell nothing."""
    return math.sqrt((n_pos + n_neg + 1) / (12.0 * n_pos * n_neg)) if n_pos and n_neg else math.inf


def few(n_pos: int, n_neg: int) -> bool:
    """Whether a class has so few rows that even a good model may not show."""
    return min(n_pos, n_neg) < ENOUGH


def beats_chance(scored: DataFrame, label: str = LABEL) -> bool:
    """Whether scores rank the label better than scores that tell nothing do, but once in forty times.

    With few rows of a class nothing is asked.
    """
    found = evaluate.discrimination(scored, "score", label).first()
    if few(found["n_pos"], found["n_neg"]):
        return True
    return found["auc"] > 0.5 + 2 * _noise(found["n_pos"], found["n_neg"])


def _fitted(run: ModelRun, model: PipelineModel) -> DataFrame:
    """The test rows with what must hold of their scores, and of the model that made them."""
    scored = training.positive_probability(model, run.test)
    return _checked(scored, "subject_id", LABEL).withColumn("above_chance", F.lit(beats_chance(scored)))


@register
def train_gbt_weighted(t: CreditTables) -> DataFrame:
    run = model_run(t)
    return _fitted(run, run.weighted)


@register
def train_gbt_balanced(t: CreditTables) -> DataFrame:
    run = model_run(t)
    return _fitted(run, run.balanced)


@register
def train_logreg_stepwise(t: CreditTables) -> DataFrame:
    """Also whether the weights are at the optimum, and every chosen feature gained enough."""
    run = model_run(t)
    model, steps = run.logreg
    slope = training.logistic_slope(model, run.train.fillna(0), LABEL)
    aucs = [0.5, *(step.auc for step in steps)]
    gained = all(later > earlier + MIN_GAIN for earlier, later in zip(aucs, aucs[1:]))
    return _fitted(run, model).withColumns({"at_optimum": F.lit(slope < 1e-4), "gains_hold": F.lit(gained)})


@register
def model_comparison(t: CreditTables) -> DataFrame:
    """For each model: Gini from AUC, and AUC above chance, at least half as far from it as that of the true
    probability, and not beyond that."""
    run = model_run(t)
    truth = evaluate.discrimination(run.test, "pd_true", LABEL).first()
    noise, unasked = _noise(truth["n_pos"], truth["n_neg"]), few(truth["n_pos"], truth["n_neg"])
    again = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="score", numBins=0)
    scores = {name: again.evaluate(training.positive_probability(m, run.test)) for name, m in run.models.items()}
    same = F.create_map(*[F.lit(x) for pair in scores.items() for x in pair])[F.col("model")]
    return run.comparison.select(
        "model",
        (F.abs(F.col("gini") - (2 * F.col("auc") - 1)) < 1e-12).alias("gini_follows"),
        (F.abs(F.col("auc") - same) < 1e-9).alias("auc_agrees"),
        (F.lit(unasked) | (F.col("auc") > 0.5 + 2 * noise)).alias("above_chance"),
        (F.lit(unasked) | (F.col("auc") - 0.5 > (truth["auc"] - 0.5) / 2)).alias("halfway_to_truth"),
        (F.col("auc") < truth["auc"] + 3 * noise).alias("below_truth"),
    )


@register
def rank_models(t: CreditTables) -> DataFrame:
    """The stored metrics of the best model, read back with it, in their order."""
    run = model_run(t)
    _, stored = training.load_model(t.spark, run.stored, "PD_MODEL", mart.MODEL_VERSION)
    order = Window.partitionBy().orderBy(F.desc("auc"), "model")  # one row for each model
    return stored.select(
        F.row_number().over(order).cast("bigint").alias("place"),
        F.coalesce(F.col("auc") <= F.lag("auc").over(order), F.lit(True)).alias("not_better_than_the_last"),
        F.col("model").isin(list(run.models)).alias("known"),
    )


@register
def roc_long(t: CreditTables) -> DataFrame:
    """For each model: whether its curve goes from (0, 0) to (1, 1) without falling, and encloses its AUC."""
    run = model_run(t)
    curves = training.model_curves(run.models, run.test, LABEL)
    order = Window.partitionBy("model").orderBy(F.desc("threshold"))
    before = [F.lag(c).over(order).alias(f"{c}_before") for c in ("fpr", "tpr")]
    steps = curves.select("model", "threshold", "fpr", "tpr", *before)
    width = F.col("fpr") - F.coalesce("fpr_before", F.lit(0.0))
    height = (F.col("tpr") + F.coalesce("tpr_before", F.lit(0.0))) / 2
    ends = steps.groupBy("model").agg(
        F.max_by(F.struct("fpr", "tpr"), "threshold").alias("first"),
        F.min_by(F.struct("fpr", "tpr"), "threshold").alias("last"),
        F.bool_and(F.coalesce((F.col("fpr") >= F.col("fpr_before")) & (F.col("tpr") >= F.col("tpr_before")), F.lit(True))).alias("never_falls"),
        F.sum(width * height).alias("area"),
    )
    return ends.join(run.comparison, "model").select(
        "model",
        ((F.col("first.fpr") == 0) & (F.col("first.tpr") == 0)).alias("from_the_origin"),
        ((F.col("last.fpr") == 1) & (F.col("last.tpr") == 1)).alias("to_one"),
        "never_falls",
        (F.abs(F.col("area") - F.col("auc")) < 1e-9).alias("area_is_auc"),
    )


@register
def predict_sample(t: CreditTables) -> DataFrame:
    """Class predictions for ten encoded rows."""
    run = model_run(t)
    rows = run.test.orderBy("subject_id").limit(10)
    checked = _checked(training.positive_probability(run.weighted, rows), "subject_id")
    return checked.withColumn("above_chance", F.lit(beats_chance(training.positive_probability(run.weighted, run.test))))


@register
def score_batch_model(t: CreditTables) -> DataFrame:
    """All subjects scored by the stored model, the results stored and read back."""
    run = model_run(t)
    inputs = encode.fill_zero(encode.scoring_view(t.model_inputs))
    scored = training.score_stored(t.spark, run.stored, "PD_MODEL", mart.MODEL_VERSION, inputs, SCORED_AT)
    stored = tables.replace_table(scored, scratch_path(t.spark, "model-scores"))
    pd = F.col("pd_probability")
    decided = F.when(pd < fv.PD_APPROVE_BELOW, "APPROVE").when(pd < fv.PD_REVIEW_BELOW, "REVIEW").otherwise("REJECT")
    return stored.select(
        "subject_id",
        pd.between(0, 1).alias("pd_in_range"),
        (F.col("credit_score") == 300 + F.round(550 * (1 - pd))).alias("score_follows"),
        (F.col("decision") == decided).alias("decision_follows"),
        "scored_at",
        "model_version",
    )


def _class_monitors(t: CreditTables) -> tuple[DataFrame, DataFrame]:
    """What the model predicted for its training rows, and for the rows it had not seen."""
    run = model_run(t)
    return training.monitored(run.weighted, run.train, BASELINE_AT), training.monitored(run.weighted, run.test, SOURCE_AT)


@register
def monitor_predicted_class(t: CreditTables) -> DataFrame:
    """Both monitor tables of the predicted class, as written."""
    stored = [
        tables.replace_table(df, scratch_path(t.spark, f"class-{name}")).withColumn("part", F.lit(name))
        for name, df in zip(["baseline", "source"], _class_monitors(t))
    ]
    both = stored[0].unionByName(stored[1])
    return both.select("subject_id", LABEL, "scored_at", "part", F.col("prediction").isin(0, 1).alias("class_known"))


@register
def drift_predicted_class(t: CreditTables) -> DataFrame:
    """Difference of the mean predicted class, by day."""
    baseline, source = _class_monitors(t)
    found = drift.difference_of_means(source, baseline, "scored_at", ["prediction"], CLASS_AS_OF)
    return found.select(
        "day", "feature", "n",
        (F.abs(F.col("difference") - (F.col("mean") - F.col("baseline_mean"))) < 1e-12).alias("difference_follows"),
        (F.col("mean").between(0, 1) & F.col("baseline_mean").between(0, 1)).alias("means_are_shares"),
    )


def _event_stream(t: CreditTables) -> DataFrame:
    return jobs.table_stream(t.spark, t.folder, t.raw("events").schema, "events.parquet")


@cache
def request_features(t: CreditTables) -> BucketedTable:
    """The features of subjects that can be scored, in buckets by subject, built once for a data folder."""
    features = t.subjects.where(F.col("monthly_income") > 0).drop("pd_true_prob", "default_flag")
    return BucketedTable.create(features, scratch_path(t.spark, "request-features"), "subject_id")


@register
def stream_score(t: CreditTables) -> DataFrame:
    requests = _event_stream(t).select("event_id", F.col("user_id").alias("subject_id"))
    features = request_features(t)
    ratio = c.dti_nullable(F.col("monthly_installment"), F.col("monthly_income"))
    capped = F.least(F.coalesce(ratio, F.lit(3.0)), F.lit(3.0))
    pd = F.round(c.probability(c.latent_logit(capped)), 6)
    state, sink = jobs.stream_paths(t.spark, "score")
    return jobs.stream_score(requests, features, "subject_id", "event_id", pd, state, sink)


@register
def stream_drift(t: CreditTables) -> DataFrame:
    baseline, _ = monitor_sets(t)
    later = _event_stream(t).where(F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz"))
    state, sink = jobs.stream_paths(t.spark, "drift")
    df = jobs.stream_drift(in_period(later, "ts", EVENTS_AS_OF), baseline, "ts", "value", state, sink)
    return rounded(df, mean=6, baseline_mean=6, difference=6)


@cache
def stored_outcomes(t: CreditTables) -> tuple[DataFrame, DataFrame]:
    """Predictions and, in files of their own, the outcomes that become known days after them."""
    made = t.predictions.select("event_id", "scored_at", "pd_true_prob")
    days = F.col("event_id") % 20
    outcomes = t.predictions.where("default_flag IS NOT NULL").select(
        "event_id", F.expr("scored_at + make_dt_interval(cast(event_id % 20 AS int))").alias("known_at"), "default_flag",
        F.floor(days / 7).cast("int").alias("part"),
    )
    # Three files that come one after the other, the earliest outcomes first.
    return made, materialize(outcomes.repartitionByRange(3, "part").drop("part"), "outcomes")


@register
def stream_performance(t: CreditTables) -> DataFrame:
    """Performance by day from streams of predictions and of outcomes that are known later."""
    made, outcomes = stored_outcomes(t)
    folders = [jobs.stored_folder(df) for df in (t.predictions, outcomes)]
    predictions = jobs.table_stream(t.spark, folders[0], t.predictions.schema).select(*made.columns)
    known = jobs.table_stream(t.spark, folders[1], outcomes.schema, files_per_batch=1)
    state, store = jobs.stream_paths(t.spark, "performance")
    df = jobs.stream_performance(
        predictions, known, "event_id", "scored_at", "known_at", "pd_true_prob", "default_flag", state, store,
        lateness="60 days", threshold=fv.PD_REVIEW_BELOW,
    )
    return rounded(df, accuracy=9, auc=9)


@register
def stream_feature_refresh(t: CreditTables) -> DataFrame:
    base, _ = upsert_inputs(t)

    def summarise(batch: DataFrame) -> DataFrame:
        purchase = F.when(F.col("event_type") == "purchase", F.col("value"))
        return batch.groupBy(F.col("user_id").alias("subject_id")).agg(
            F.round(F.max(purchase) / 1000, 3).alias("credit_utilization"),
            F.count_if(F.col("event_type") == "signup").alias("num_inquiries_12m"),
        )

    state, versions = jobs.stream_paths(t.spark, "refresh")
    return jobs.stream_feature_refresh(
        _event_stream(t), summarise, base, "subject_id", ("num_inquiries_12m",), state, versions
    )
