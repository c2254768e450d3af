"""Forward selection for logistic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.encode import scale_parameters, standard_scale
from riskloom.operators.evaluate import discrimination
from riskloom.session import materialize

MIN_GAIN = 1e-4
MAX_ITERATIONS = 200
#: Newton steps whose loss would fall by less than this, over all rows, are the last ones.
LEAST_DECREMENT = 1e-8
ROWS_PER_TASK = 10_000
MOST_ROWS_PER_TASK = 100_000


@dataclass(frozen=True)
class Step:
    feature: str
    auc: float


def fit_logistic(
    rows: DataFrame, features: str, label: str, n: int, c: float = 1.0, max_iter: int = MAX_ITERATIONS
) -> LogisticRegressionModel:
    """L2-penalised logistic regression, penalty 1/c on the sum of the losses, free intercept.

    Spark penalises the mean loss, so its parameter is 1/(c n). Not converging is an error.
    """
    model = LogisticRegression(
        labelCol=label, featuresCol=features, maxIter=max_iter, tol=1e-8, regParam=1.0 / (c * max(n, 1)),
        standardization=False,
    ).fit(rows)
    if model.summary.totalIterations >= max_iter:
        raise ArithmeticError(f"logistic regression did not converge in {max_iter} iterations")
    return model


def _sums_at(trials: dict[int, tuple[list[int], np.ndarray]]):
    """For `mapInPandas`: loss, gradient and Hessian of the rows at the trial weights of every candidate, by cell."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            y, x = batch["y"].to_numpy(float), np.stack(batch["x"].to_numpy())
            for i, (columns, w) in trials.items():
                rows = np.column_stack([np.ones(len(y)), x[:, columns]])
                z = rows @ w
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                loss, slope = (np.logaddexp(0, z) - y * z).sum(), rows.T @ (p - y)
                bend = rows.T @ (rows * (p * (1 - p))[:, None])
                found[i] = found.get(i, 0.0) + np.concatenate([[loss], slope, bend.ravel()])
        for i, cells in found.items():
            yield pd.DataFrame({"candidate": i, "cell": np.arange(len(cells)), "value": cells})

    return sums


def fit_candidates(
    train: DataFrame, candidates: dict[int, list[int]], start: dict[int, np.ndarray], max_iter: int = MAX_ITERATIONS
) -> dict[int, np.ndarray]:
    """Intercept and weights of an L2-penalised logistic regression on each candidate's columns, fitted together.

    `train` holds `y` (0 or 1) and `x`, an array. The loss is that of `fit_logistic` with c = 1. Every Newton step of
    all candidates is one job, and the driver receives a loss, gradient and Hessian for each; a step that raises the loss is
    halved. Not converging is an error. The fits begin at the weights in `start`.
    """
    at = {i: (np.asarray(start[i], float), None, None) for i in candidates}  # weights, their loss, the step from them
    trials, done = {i: w for i, (w, _, _) in at.items()}, {}
    for _ in range(max_iter):
        asked = {i: (candidates[i], w) for i, w in trials.items()}
        cells = train.mapInPandas(_sums_at(asked), "candidate int, cell int, value double")
        added = cells.groupBy("candidate", "cell").agg(F.sum("value").alias("value")).collect()
        sums = {i: np.zeros(1 + len(w) + len(w) ** 2) for i, w in trials.items()}
        for row in added:
            sums[row["candidate"]][row["cell"]] = row["value"]
        following = {}
        for i, w in trials.items():
            penalty = np.concatenate([[0.0], np.ones(len(w) - 1)])
            loss = sums[i][0] + (penalty * w * w).sum() / 2
            before, least, step = at[i]
            if least is not None and not loss <= least + 1e-9 * abs(least):
                at[i] = (before, least, step / 2)
                following[i] = before + step / 2
                continue
            slope = sums[i][1 : 1 + len(w)] + penalty * w
            bend = sums[i][1 + len(w) :].reshape(len(w), -1) + np.diag(penalty)
            step = -np.linalg.lstsq(bend, slope, rcond=None)[0]
            if -slope @ step / 2 < LEAST_DECREMENT:
                done[i] = w + step
            else:
                at[i] = (w, loss, step)
                following[i] = w + step
        trials = following
        if not trials:
            return done
    raise ArithmeticError(f"logistic regression did not converge in {max_iter} iterations")


def best_candidate(aucs: list[tuple[int, float | None]], best: float, min_gain: float = MIN_GAIN) -> int | None:
    """The leader after all candidates, in ranked order: one takes the lead if it is better than
    the leader, at first the best result so far, by more than `min_gain`."""
    leader = None
    for candidate, auc in aucs:
        if auc is not None and auc > best + min_gain:
            leader, best = candidate, auc
    return leader


def forward_selection(
    fit: DataFrame,
    validate: DataFrame,
    features: list[str],
    label: str,
    max_rounds: int = 20,
    min_gain: float = MIN_GAIN,
) -> list[Step]:
    """Add the winner of each round until none gains enough; `features` are in ranked order.

    Every remaining feature is tried in every round, all of them fitted together, one job per Newton step. Inputs
    are scaled with the parameters of `fit`; a missing value counts as 0. One job ranks all candidates of a round.
    """
    filled_fit, filled_validate = (df.select(label, *features).fillna(0, features) for df in (fit, validate))
    parameters = scale_parameters(filled_fit, features)
    assembler = VectorAssembler(inputCols=features, outputCol="all")

    def prepared(df: DataFrame, name: str) -> DataFrame:
        scaled = standard_scale(df, parameters)
        rows = assembler.transform(scaled).select(F.col(label).cast("int").alias("y"), vector_to_array("all").alias("x"))
        return materialize(rows, name)

    train, values = prepared(filled_fit, "stepwise-fit"), prepared(filled_validate, "stepwise-validate")
    n, known, positive = train.agg(F.count(F.lit(1)), F.count_if(F.col("y").isin(0, 1)), F.sum("y")).first()
    if known < n:
        raise ValueError("labels must be 0 or 1")
    # All Newton steps read these rows: even partitions, kept in memory where they fit and else on disk.
    # Each task sends the sums of every candidate, so beyond a few tasks a core, tasks take more rows instead.
    few = 4 * train.sparkSession.sparkContext.defaultParallelism
    tasks = min(-(-n // ROWS_PER_TASK), max(few, -(-n // MOST_ROWS_PER_TASK)))
    train = train.repartition(tasks).persist()

    chosen: list[int] = []
    steps: list[Step] = []
    best = 0.5
    weights = np.zeros(1)
    for _ in range(max_rounds):
        candidates = {i: [*chosen, i] for i in range(len(features)) if i not in chosen}
        if not candidates:
            break
        # One class alone has no finite intercept, and no feature tells anything.
        start = {i: np.append(weights, 0.0) for i in candidates}
        fitted = fit_candidates(train, candidates, start) if 0 < positive < n else start
        scores = [
            F.expr(" + ".join(["0D", *(f"{float(w)!r}D * x[{j}]" for j, w in zip(own, fitted[i][1:]))])).alias(str(i))
            for i, own in candidates.items()
        ]
        long = values.select("y", *scores).unpivot(["y"], [str(i) for i in candidates], "name", "score")
        ranked = discrimination(long, "score", "y", ["name"]).select("name", "auc").collect()
        aucs = {int(row["name"]): row["auc"] for row in ranked}
        winner = best_candidate([(i, aucs.get(i)) for i in candidates], best, min_gain)
        if winner is None:
            break
        best, weights = aucs[winner], fitted[winner]
        chosen.append(winner)
        steps.append(Step(features[winner], best))
    train.unpersist()
    return steps
