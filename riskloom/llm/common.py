"""Helpers shared by the operators: block-wise text functions and corpus paths."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.joins import broadcast_if_small
from riskloom.session import materialize

#: Texts handed to one call of a block function, by rows and by characters, whichever is reached first.
BLOCK_ROWS, BLOCK_CHARS = 4096, 8_000_000


#: DuckDB's expression of the CRC-32 check sum of a text's UTF-8 bytes, for check SQL.
CRC32_SQL = (
    "xor(list_reduce(list_concat([4294967295], list_transform(range(strlen({text})),"
    " lambda b: cast('0x' || substr(hex({text}), 2 * b + 1, 2) AS BIGINT))),"
    " lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),"
    " lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)

#: Rows and bytes that Spark hands to Python at once, so that workers stay small beside their executor.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def _size(text: str) -> int:
    """A setting such as 2000, 67108864b or 64m as a number; anything else counts as no bound."""
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", text.strip().lower())
    return int(found[1]) << 10 * " kmgt".index(found[2] or " ") if found else 0


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to the sizes above; only memory and speed depend on it."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        if not 0 < _size(spark.conf.get(key)) <= most:
            spark.conf.set(key, str(most))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def blocks(texts: list, rows: int = BLOCK_ROWS, chars: int = BLOCK_CHARS) -> Iterator[list]:
    """Cut a list of texts into runs of bounded size; a single longer text is a run of its own."""
    block, held = [], 0
    for text in texts:
        size = len(text) if text is not None else 0
        if block and (len(block) >= rows or held + size > chars):
            yield block
            block, held = [], 0
        block.append(text)
        held += size
    if block:
        yield block


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers wait for their next one beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def text_udf(kind: str, arrow_type: pa.DataType, prepare: Callable[[], Callable[..., list]]) -> Callable[..., Column]:
    """A column function over text blocks.

    `prepare` runs once per task and returns the block function, which takes one list per column and
    returns one value per row.
    """

    @F.arrow_udf(kind)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = prepare()
        for batch in batches:
            texts, done = batch.to_pylist(), []
            for block in blocks(texts):
                done.append(pa.array(run(block), type=arrow_type))
            yield pa.concat_arrays(done) if done else pa.array([], type=arrow_type)
        run = batch = texts = done = None  # noqa: F841
        give_back()

    return apply


#: A key is hot if it has at least one row in so many; fewer keys than this can be hot.
HOT_PARTS = 2000


def join_counted(rows: DataFrame, counted: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join of `rows` to `counted`, which has one row for each key with the rows of the key in `count`.

    Hot keys, of which there are fewer than HOT_PARTS, are joined by broadcasting their few rows of
    `counted`; the others by a shuffle in which no key has more than one row in HOT_PARTS of `total`.
    """
    hot = F.col("count") * HOT_PARTS >= F.lit(total)
    values = [c for c in counted.columns if c != key]
    few = counted.where(hot).select(key, F.struct(*values).alias("hot_values"))
    marked = rows.join(F.broadcast(few), key, "left")
    often = marked.where("hot_values IS NOT NULL").select(*rows.columns, *[F.col(f"hot_values.{c}").alias(c) for c in values])
    rest = marked.where("hot_values IS NULL").select(*rows.columns).join(counted.where(~hot), key)
    return often.unionByName(rest.select(*rows.columns, *values))


def told_apart(rows: DataFrame) -> DataFrame:
    """Rows of classes with two 64-bit names, node and other: of classes that share the first name each goes by
    its second, so that classes are as good as named by 128 bits."""
    twins = rows.groupBy("node").agg(F.min("other").alias("low"), F.max("other").alias("high"))
    twins = materialize(twins.where("low <> high").select("node", F.lit(True).alias("twin")), "twin-names")
    if not twins.limit(1).count():
        return rows
    named = rows.join(broadcast_if_small(twins), "node", "left")
    node = F.when(F.col("twin"), F.col("other")).otherwise(F.col("node"))
    return materialize(named.withColumn("node", node).select(*rows.columns), "told-apart")


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked positions the least label of their group."""
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return
        for side in (a, b):
            np.minimum.at(label, label[side], low)
            np.minimum.at(label, side, low)
        while (label[label] != label).any():
            label[:] = label[label]
