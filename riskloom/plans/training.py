"""The three default-probability models, their comparison and their storage."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import ElementwiseProduct, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.encode import scale_parameters
from riskloom.operators.evaluate import discrimination, roc_curve, univariate_rank
from riskloom.operators.ranks import smallest_hash_rows
from riskloom.operators.stepwise import fit_logistic, forward_selection
from riskloom.plans.mart import score_results
from riskloom.session import materialize, scratch_root

SEED = 42
ROWS_PER_TASK = 50_000


def boosted_rows(train: DataFrame) -> DataFrame:
    """All training rows, stored in partitions that are worth a task each.

    A boosted model passes over its rows thousands of times.
    """
    return materialize(train.coalesce(max(1, -(-train.count() // ROWS_PER_TASK))), "boosted-train")


def _boosted(features: list[str], label: str, weight: str, **parameters) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="features"),
            GBTClassifier(
                labelCol=label, featuresCol="features", weightCol=weight, seed=SEED, **parameters
            ),
        ]
    )


def with_checkpoints(df: DataFrame) -> None:
    """Boosting cuts its lineage every ten trees if a checkpoint folder is known."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(df.sparkSession))


def train_gbt_weighted(
    train: DataFrame, features: list[str], label: str, trees: int = 300, positive_weight: float = 10.0
) -> PipelineModel:
    """Boosted trees of depth 6 with a fixed weight on the positive class.

    Columns are sampled per node; per-tree column sampling does not exist in Spark ML.
    """
    with_checkpoints(train)
    weighted = train.withColumn("_w", F.when(F.col(label) == 1, positive_weight).otherwise(1.0))
    model = _boosted(
        features, label, "_w", maxIter=trees, maxDepth=6, stepSize=0.1, subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
    )
    return model.fit(weighted)


def train_gbt_balanced(
    train: DataFrame, features: list[str], label: str, trees: int = 400
) -> PipelineModel:
    """Boosted trees with classes weighted to equal totals; depth 6 stands in for 48 leaves."""
    with_checkpoints(train)
    total, positive = train.agg(F.count(label), F.count_if(F.col(label) == 1)).first()
    each = total / 2.0
    weight = F.when(F.col(label) == 1, each / max(positive, 1)).otherwise(each / max(total - positive, 1))
    model = _boosted(
        features, label, "_w", maxIter=trees, maxDepth=6, stepSize=0.05, subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
    )
    return model.fit(train.withColumn("_w", weight))


def train_logreg_stepwise(
    train: DataFrame,
    numeric: list[str],
    id_: str,
    label: str,
    sample: int | None = None,
    keep: int = 30,
    max_rounds: int = 20,
) -> tuple[PipelineModel, list]:
    """Rank features alone, select forward on a stratified 70/30 split, fit on all rows.

    All of `train` is used, or exactly `sample` rows if a caller asks for so many. Missing values count
    as 0. The final fit divides each feature by its population deviation; centring it would only move
    the intercept, which is free.
    """
    rows = train.select(id_, label, *numeric)
    if sample is not None:
        rows = smallest_hash_rows(rows, id_, "logreg", n=sample)
    doubles = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in numeric]
    rows = materialize(rows.select(id_, label, *doubles), "logreg-rows")
    ranked = [r["feature"] for r in univariate_rank(rows, numeric, label, keep).collect()]
    fit = materialize(
        smallest_hash_rows(rows, id_, "stepwise", strata=label, fraction=0.7), "logreg-fit"
    )
    validate = rows.join(fit.select(id_), id_, "left_anti")
    steps = forward_selection(fit, validate, ranked, label, max_rounds)
    chosen = [s.feature for s in steps] or ranked[:1]
    parameters = scale_parameters(rows, chosen)
    scaling = Vectors.dense([1.0 / parameters[name][1] for name in chosen])
    inputs = Pipeline(
        stages=[
            VectorAssembler(inputCols=chosen, outputCol="raw", handleInvalid="keep"),
            ElementwiseProduct(scalingVec=scaling, inputCol="raw", outputCol="features"),
        ]
    ).fit(rows)
    model = fit_logistic(inputs.transform(rows), "features", label, rows.count(), max_iter=500)
    return PipelineModel([*inputs.stages, model]), steps


def logistic_slope(model: PipelineModel, rows: DataFrame, label: str) -> float:
    """The largest slope of the penalised loss per row at the weights of a stepwise model; 0 at its optimum."""
    *inputs, fitted = model.stages
    placed = PipelineModel(inputs).transform(rows).select(F.col(label).alias("y"), vector_to_array("features").alias("x"))
    weights = [float(w) for w in fitted.coefficients]
    logit = sum((F.lit(w) * F.col("x")[i] for i, w in enumerate(weights)), F.lit(float(fitted.intercept)))
    error = 1 / (1 + F.exp(-logit)) - F.col("y")
    sums = placed.agg(
        F.count("y").alias("n"), F.sum(error).alias("s"), *[F.sum(error * F.col("x")[i]).alias(f"s{i}") for i in range(len(weights))]
    ).first()
    slopes = [sums["s"], *(sums[f"s{i}"] + w for i, w in enumerate(weights))]
    return max(abs(s) for s in slopes) / max(sums["n"], 1)


def score_stored(
    spark: SparkSession, root: str, name: str, version: str, subjects: DataFrame, scored_at: str | None = None
) -> DataFrame:
    """Score results of all subjects by a stored model: probability, score, decision, time and version."""
    model, _ = load_model(spark, root, name, version)
    scored = positive_probability(model, subjects)
    return score_results(scored, F.col("score"), version, scored_at)


def monitored(model: PipelineModel, rows: DataFrame, scored_at: str) -> DataFrame:
    """Rows with the model's class and the time of scoring, as drift monitors read them."""
    return positive_probability(model, rows).withColumn("scored_at", F.lit(scored_at).cast("timestamp_ntz"))


def positive_probability(model: PipelineModel, df: DataFrame) -> DataFrame:
    """`df` with the probability of the positive class as `score` and the class as `prediction`."""
    out = model.transform(df)
    return out.select(
        *df.columns,
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def scored_by_all(models: dict[str, PipelineModel], test: DataFrame, label: str) -> DataFrame:
    """(model, label, score) for every model and test row."""
    parts = [
        positive_probability(model, test).select(F.lit(name).alias("model"), label, "score")
        for name, model in models.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def model_comparison(models: dict[str, PipelineModel], test: DataFrame, label: str) -> DataFrame:
    """AUC and Gini per model, the best first; all models are ranked in one job."""
    ranked = discrimination(scored_by_all(models, test, label), "score", label, ["model"])
    return ranked.select("model", "auc", "gini").orderBy(F.desc("auc"), "model")


def model_curves(models: dict[str, PipelineModel], test: DataFrame, label: str) -> DataFrame:
    return roc_curve(scored_by_all(models, test, label), "score", label, ["model"])


def best_model(comparison: DataFrame) -> str:
    """Name of the model with the highest AUC."""
    return comparison.first()["model"]


def save_model(model: PipelineModel, metrics: DataFrame, root: str, name: str, version: str) -> None:
    """Store a model and its metrics under name and version, replacing an earlier run."""
    model.write().overwrite().save(f"{root}/{name}/{version}/model")
    metrics.write.mode("overwrite").parquet(f"{root}/{name}/{version}/metrics")


def load_model(spark: SparkSession, root: str, name: str, version: str) -> tuple[PipelineModel, DataFrame]:
    path = f"{root}/{name}/{version}"
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/metrics")
