"""Quality classifier: random-indexing word vectors and a small calibrated network.

Words and runs of signs are hashed to `BUCKETS` word types. Every type has a fixed sparse random index
vector; its word vector is the sum of the index vectors of its neighbours in the training texts, at
unit length (its own index vector if it has no neighbours there), less the mean of all. A document is pooled to the mean and
spread of its word vectors, the likeness of near ones, and its size. A two-layer network in numpy
is trained on these, and the temperature of its probabilities is fitted on training rows it has not
seen. Rows are weighed so that the labels have their shares among all labelled rows.

Only the fit uses a sample: at most `TRAIN_ROWS` labelled rows, half of each label, those with the
least hashes of their ids. Scoring covers all rows and whole texts.

Defined cases: a null, empty or white text has no words and gets the network's score of that; labels that
are null or belong to no document are not used; several labels of one document count as their mean,
rounded up; several documents of one id give one training row; other columns are not read; without
rows of both labels every score is 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import blocks, give_back, small_batches, table
from riskloom.session import materialize

#: Most labelled rows that a model is trained on.
TRAIN_ROWS = 6000
BUCKETS, WIDTH, WINDOW, HIDDEN, STEPS, SEED = 16384, 32, 2, 24, 800, 11
#: Distances at which the likeness of words is pooled.
NEAR = 2
#: Words whose vectors are held at once.
STRIP = 50_000
#: Words a task remembers before it starts afresh.
CACHE_WORDS = 100_000
_WORD = re.compile(r"\w+|[^\w\s]+")


class Buckets:
    """Turns texts into arrays of word types, hashing each distinct word once."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.types = np.zeros(0, np.int32)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The types of all words of the texts, and how many each text has."""
        if len(self.number) > CACHE_WORDS:
            self._clear()
        numbers, sizes = [], []
        for text in texts:
            words = _WORD.findall(text or "")
            numbers.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
            sizes.append(len(words))
        fresh = islice(self.number, len(self.types), None)
        added = np.fromiter((zlib.crc32(word.encode()) % BUCKETS for word in fresh), np.int32)
        self.types = np.concatenate((self.types, added))
        return self.types[np.concatenate(numbers)] if numbers else self.types[:0], np.array(sizes, np.int64)


def index_vectors() -> np.ndarray:
    """The fixed random vectors: one in five entries is 1 or -1."""
    draws = np.random.default_rng(SEED).integers(0, 10, (BUCKETS, WIDTH))
    return (draws == 0).astype(np.int64) - (draws == 1)


def contexts(types: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For every word type, the sum of the index vectors around its occurrences."""
    total = np.zeros((BUCKETS, WIDTH), np.int64)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(1, WINDOW + 1):
        near = np.flatnonzero(text_of[step:] == text_of[:-step])
        left, right = types[near], types[near + step]
        for i in range(WIDTH):
            total[:, i] += np.bincount(left, index[right, i], BUCKETS).astype(np.int64)
            total[:, i] += np.bincount(right, index[left, i], BUCKETS).astype(np.int64)
    return total


def unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def pooled(types: np.ndarray, sizes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of each text's word vectors: mean, spread, likeness of neighbours, length of the mean; and log size.

    All but the size are zero where a text has no word.
    """
    n_texts, n = len(sizes), np.maximum(sizes, 1)[:, None]
    text_of = np.repeat(np.arange(n_texts), sizes)
    total, square, near = np.zeros((n_texts, WIDTH)), np.zeros((n_texts, WIDTH)), np.zeros((n_texts, NEAR))
    # Strips bound the memory that a very long text takes.
    for start in range(0, len(types), STRIP):
        rows, owner = vectors[types[start : start + STRIP + NEAR]], text_of[start : start + STRIP + NEAR]
        own_rows, own_text = rows[:STRIP], owner[:STRIP]
        firsts = np.flatnonzero(np.concatenate(([True], own_text[1:] != own_text[:-1])))
        total[own_text[firsts]] += np.add.reduceat(own_rows, firsts, axis=0, dtype=np.float64)
        square[own_text[firsts]] += np.add.reduceat(own_rows * own_rows, firsts, axis=0, dtype=np.float64)
        for step in range(1, NEAR + 1):
            later, here = rows[step : STRIP + step], min(STRIP, len(rows) - step)
            if here > 0:
                alike = np.einsum("ij,ij->i", later[:here], rows[:here])
                alike[owner[step : here + step] != owner[:here]] = 0
                near[:, step - 1] += np.bincount(owner[:here], alike, n_texts)
    mean = total / n
    spread = np.sqrt(np.maximum(square / n - mean**2, 0))
    near /= np.maximum(n - np.arange(1, NEAR + 1), 1)
    length = np.linalg.norm(mean, axis=1)
    return np.column_stack((mean, spread, near, length, np.log1p(sizes)))


@dataclass
class Network:
    """Two layers, tanh between them; `temperature` divides the logit."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -60, 60)))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Network:
    """Full-batch Adam on the weighted log loss with a small penalty."""
    rng = np.random.default_rng(SEED)
    net = Network(
        x.mean(0),
        x.std(0) + 1e-9,
        rng.normal(0, WIDTH**-0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        0.0,
    )
    z = (x - net.centre) / net.scale
    values = [net.first, net.first_bias, net.second, np.zeros(1)]
    moment, spread = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, STEPS + 1):
        hidden = np.tanh(z @ values[0] + values[1])
        error = weight * (1 / (1 + np.exp(-np.clip(hidden @ values[2] + values[3], -60, 60))) - y) / weight.sum()
        back = np.outer(error, values[2]) * (1 - hidden**2)
        slopes = [z.T @ back + 2e-4 * values[0], back.sum(0), hidden.T @ error + 2e-4 * values[2], error.sum(keepdims=True)]
        for v, m, s, g in zip(values, moment, spread, slopes):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.second_bias = float(values[3][0])
    return net


def calibrate(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The temperature of the least log loss, by golden-section search on its logarithm.

    Targets are drawn in by one row in the size of their label, so that rows which the network parts
    fully do not ask for certainty.
    """
    logit, n = net.logit(x), (y == 1).sum()
    y = np.where(y == 1, (n + 1) / (n + 2), 1 / (len(y) - n + 2))

    def loss(log_t: float) -> float:
        z = logit / np.exp(log_t)
        return float((weight * (np.logaddexp(0, z) - y * z)).sum())

    low, high, part = np.log(0.01), np.log(100.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    vectors: np.ndarray
    net: Network | None

    def scores(self, types: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.net is None:
            return np.full(len(sizes), 0.5)
        return self.net.score(pooled(types, sizes, self.vectors))


def known_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, label), one row for each labelled id."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna()
    return known.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))


def training_rows(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(id, label, text), at most `rows` of them; `known` holds what may be learned from."""
    mixed = F.xxhash64(F.lit(SEED), "id")
    halves = [known.where(F.col("label") == y).orderBy(mixed, "id").limit(rows // 2) for y in (0, 1)]
    chosen = materialize(halves[0].unionByName(halves[1]), "quality-labels")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The chosen rows are at most `rows`, so they fit any executor.
    found = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    return materialize(found, "quality-training")


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", rows=TRAIN_ROWS) -> Model:
    """Train on documents of `labels`; what is held out must not be in it."""
    known = known_labels(labels, id_col, label_col)
    sample = training_rows(docs, known, id_col, text_col, rows)

    def context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words, index = np.zeros((BUCKETS, WIDTH), np.int64), Buckets(), index_vectors()
        for batch in batches:
            for block in blocks(batch.column(0).to_pylist(), chars=2_000_000):
                total += contexts(*words.of(block), index)
        used = np.flatnonzero(total.any(axis=1))
        words = None
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(used)] + [pa.array(total[used, i]) for i in range(WIDTH)], ["type", *names])

    names = [f"v{i}" for i in range(WIDTH)]
    # Eight parts keep the partial tables (at most BUCKETS rows each) few; the sample itself is bounded.
    parts = sample.select("text").repartition(8).mapInArrow(context_rows, ", ".join(["type bigint", *(f"{n} bigint" for n in names)]))
    sums = parts.groupBy("type").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    vectors = np.zeros((BUCKETS, WIDTH))
    vectors[sums["type"].to_numpy(np.int64)] = sums[names].to_numpy(np.float64)
    unseen = ~vectors.any(axis=1)
    vectors[unseen] = index_vectors()[unseen]
    vectors = unit(vectors)
    # What all word vectors share (the pull of the commonest words) tells nothing apart.
    vectors = unit(vectors - vectors[~unseen].mean(axis=0) if not unseen.all() else vectors).astype(np.float32)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Buckets()
        for batch in batches:
            done = [pooled(*words.of(block), vectors) for block in blocks(batch.column(2).to_pylist(), chars=2_000_000)]
            rows = pa.array(np.concatenate(done).tolist() if done else [], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], ["id", "label", "x"])
        words = batch = done = rows = None  # noqa: F841
        give_back()

    rows = sample.select("id", "label", "text").mapInArrow(features, "id bigint, label int, x array<double>").toPandas()
    rows = rows.sort_values("id")
    if rows["label"].nunique() < 2:
        return Model(vectors, None)
    x, y = np.stack(rows["x"].to_numpy()), rows["label"].to_numpy(np.float64)
    share = known.agg(F.avg("label")).first()[0]
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    kept = np.array([zlib.crc32(f"calibrate {key}".encode()) % 4 == 0 for key in rows["id"]])
    if len(set(y[~kept])) < 2 or len(set(y[kept])) < 2:
        kept = np.zeros(len(y), bool)
    net = train(x[~kept], y[~kept], weight[~kept])
    if kept.any():
        net.temperature = calibrate(net, x[kept], y[kept], weight[kept])
    return Model(vectors, net)


def score(spark: SparkSession, model: Model, text_col: str = "text") -> Column:
    """The probability of label 1 for each text."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, known = Buckets(), shared.value
        for batch in batches:
            done = [known.scores(*words.of(block)) for block in blocks(batch.to_pylist(), chars=1_000_000)]
            yield pa.array(np.concatenate(done) if done else [], pa.float64())
        words = batch = done = None  # noqa: F841
        give_back()

    return scored(text_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(~held_out()).select("doc_id", "quality")
    model = fit(docs, labels)
    scored = docs.select("doc_id", held_out().alias("held_out"), score(spark, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
