"""Near-duplicate embeddings by an exact metric range join.

Vectors are compared by angle, a metric. Rows of equal vectors form one class, which is compared once.
Pivots part the vectors: each belongs to the cell of its nearest pivot. A vector y of another cell can
only be within the range of a member of cell j if its angle to pivot j exceeds the angle to its own
pivot by at most twice the range (triangle inequality), and if it lies within the range of the plane
between the two pivots; then y is also sent to cell j. Cells are cut into blocks of bounded size,
and each pair of blocks is joined on its own: a single-precision product finds pairs, a double-precision
cosine confirms them. A block pair returns counts and a spanning forest of its links, never all pairs.

The number of pivots grows with the square root of the number of vectors, up to `PIVOT_BYTES` of them.
Equal vectors are classed by two hashes of 64 bits.
Vectors in many dimensions without clusters are near all pivots; then most vectors are sent to most
cells and the join compares nearly all pairs, as any exact method must.

Defined cases: a null vector, one with null or non-finite components, and a zero vector link with
nothing; vectors link only with vectors of the same length; repeated rows of one id are other vectors
and share the id's component; a null id is a vector of its own that links with nothing. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import join_counted, merge_labels, small_batches, table, told_apart
from riskloom.llm.components import components
from riskloom.session import materialize

THRESHOLD = 0.9
#: Bytes of all pivots, which every task holds.
PIVOT_BYTES = 32 << 20
#: Vectors of one side of a block pair.
BLOCK = 8192
#: Rows that are multiplied with a whole block at once.
STRIP = 512


def pivot_count(n: int, dim: int) -> int:
    """Pivots for n vectors, as many as PIVOT_BYTES hold at most; with fewer, cells have more blocks."""
    return max(1, min(math.isqrt(n) // 16, PIVOT_BYTES // (8 * max(dim, 1))))


def cells_of(unit: np.ndarray, pivots: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each unit vector, and a table of the other cells it has to be sent to."""
    near = np.clip(unit @ pivots.T, -1, 1)
    own = near.argmax(axis=1)
    mine = near[np.arange(len(unit)), own][:, None]
    reach, slack = math.acos(threshold), 1e-9
    by_angle = np.arccos(near) - np.arccos(mine) <= 2 * reach + slack
    apart = np.sqrt(np.maximum(2 - 2 * np.clip(pivots @ pivots.T, -1, 1), 0))[own]
    by_plane = mine - near <= math.sqrt(2 - 2 * threshold) * apart + slack
    sent = by_angle & by_plane
    sent[np.arange(len(unit)), own] = False
    return own, sent


def unit_rows(data: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray]:
    kind = np.float32 if data and len(data[0]) == 4 * dim else np.float64
    rows = np.frombuffer(b"".join(data), kind).astype(np.float64).reshape(len(data), dim)
    # Scaling by the largest component first keeps the squares of huge and tiny components finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def block_links(core: np.ndarray, keys: np.ndarray, other: np.ndarray, other_keys: np.ndarray, weight: np.ndarray, threshold: float):
    """For each core row the weight of its links, and for all rows (core first) a label of their group."""
    links = np.zeros(len(core), np.int64)
    label = np.arange(len(core) + len(other))
    core32, other32 = core.astype(np.float32), other.astype(np.float32)
    for start in range(0, len(core), STRIP):
        rows, columns = np.nonzero(core32[start : start + STRIP] @ other32.T >= threshold - 1e-4)
        rows += start
        apart = keys[rows] != other_keys[columns]
        rows, columns = rows[apart], columns[apart]
        linked = np.zeros(len(rows), bool)
        for part in range(0, len(rows), 1 << 16):
            a, b = rows[part : part + (1 << 16)], columns[part : part + (1 << 16)]
            linked[part : part + (1 << 16)] = np.einsum("ij,ij->i", core[a], other[b]) >= threshold
        rows, columns = rows[linked], columns[linked]
        links += np.bincount(rows, weight[columns], len(core)).astype(np.int64)
        if len(rows):
            merge_labels(label, rows, columns + len(core))
    return links, label


def classes(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """Stored tables of members (id, node) and classes (node, id, data, dim, count); a class has equal vectors.

    Vectors of single-precision components travel as such, which loses nothing, others in double precision.
    """
    values = F.col(vec_col).cast("array<double>")
    single = vectors.schema[vec_col].dataType == T.ArrayType(T.FloatType(), vectors.schema[vec_col].dataType.containsNull)
    width, kind = (4, np.float32) if single else (8, np.float64)

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            flat = (batch.flatten().to_numpy(zero_copy_only=False) + 0.0).astype(kind)  # -0.0 becomes 0.0
            ends = np.concatenate(([0], np.cumsum(np.fromiter((len(x) for x in batch), np.int64, len(batch)))))
            yield pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())

    kept = vectors.select(F.col(id_col).cast("long").alias("id"), values.alias("values")).where(usable_on("values") & F.col("id").isNotNull())
    rows = kept.select("id", packed("values").alias("data"))
    rows = rows.withColumns({"node": F.xxhash64("data"), "other": F.xxhash64(F.lit(9), "data")})
    rows = told_apart(materialize(rows, "vectors"))
    grouped = rows.groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("count"))
    # One row of each class brings its vector; the class is joined by its hash.
    first = rows.groupBy("node").agg(F.min("data").alias("data"))
    grouped = materialize(grouped.join(first, "node").withColumn("dim", (F.length("data") / width).cast("int")), "vector-classes")
    return rows.select("id", "node"), grouped


def usable_on(column: str):
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(x) > 0) & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each row of `vectors`."""
    spark: SparkSession = vectors.sparkSession
    small_batches(spark)
    members, nodes = classes(vectors, id_col, vec_col)
    n = nodes.count()
    longest = nodes.agg(F.coalesce(F.max("dim"), F.lit(1))).first()[0]
    picked = nodes.orderBy(F.xxhash64(F.lit(3), "node")).limit(pivot_count(n, longest)).select("data", "dim").collect()
    by_dim: dict[int, list[bytes]] = {}
    for row in picked:
        by_dim.setdefault(row["dim"], []).append(bytes(row["data"]))
    base, pivots, first = 0, {}, {}
    for dim, data in sorted(by_dim.items()):
        pivots[dim], first[dim] = unit_rows(data, dim)[1], base
        base += len(data)
    shared = spark.sparkContext.broadcast((pivots, first))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, first = shared.value
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                if dim in pivots:
                    unit = unit_rows(part.column(1).to_pylist(), dim)[1]
                    own, sent = cells_of(unit, pivots[dim], threshold)
                    row, cell = np.nonzero(sent)
                    rows = np.concatenate((np.arange(len(at)), row))
                    cells = np.concatenate((own, cell)) + first[dim]
                else:  # a length that no pivot has is a cell of its own
                    rows, cells = np.arange(len(at)), np.full(len(at), -dim)
                core = np.arange(len(rows)) < len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells, pa.int64()), pa.array(core), *part.select(["node", "data", "dim", "count"]).take(pa.array(rows)).columns],
                    ["cell", "core", "node", "data", "dim", "count"],
                )

    kind = "cell bigint, core boolean, node bigint, data binary, dim int, count bigint"
    # Which cells a vector goes to is stored without the vector; sizes of cells come from it.
    placed = nodes.select("node", "data", "dim", "count").mapInArrow(assign, kind)
    sizes = placed.groupBy("cell").agg(F.count("*").alias("rows"), F.sum(F.col("core").cast("long")).alias("cores")).collect()
    block = {row["cell"]: (-(-row["cores"] // BLOCK), -(-row["rows"] // BLOCK)) for row in sizes}
    cuts = spark.sparkContext.broadcast(block)

    @F.arrow_udf("array<struct<a:int,b:int,core:boolean>>")
    def targets(cells: pa.Array, cores: pa.Array, keys: pa.Array) -> pa.Array:
        out = []
        for cell, core, key in zip(cells.to_pylist(), cores.to_pylist(), keys.to_pylist()):
            a_blocks, b_blocks = cuts.value[cell]
            mixed = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 33
            to = [{"a": a, "b": mixed % b_blocks, "core": False} for a in range(a_blocks)]
            if core:
                to += [{"a": mixed % a_blocks, "b": b, "core": True} for b in range(b_blocks)]
            out.append(to)
        return pa.array(out, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("core", pa.bool_())])))

    dealt = placed.select("cell", "node", "data", "dim", "count", F.explode(targets("cell", "core", "node")).alias("to"))
    dealt = dealt.select("cell", "to.a", "to.b", "to.core", "node", "data", "dim", "count")

    def join(group: pa.Table) -> pa.Table:
        core_at = group.column("core").to_numpy()
        keys, weight = group.column("node").to_numpy(), group.column("count").to_numpy()
        out_keys, out_links, out_roots = [], [], []
        if core_at.any() and not core_at.all():
            unit = unit_rows(group.column("data").to_pylist(), group.column("dim")[0].as_py())[1]
            links, label = block_links(unit[core_at], keys[core_at], unit[~core_at], keys[~core_at], weight[~core_at], threshold)
            both = np.concatenate((keys[core_at], keys[~core_at]))
            linked = np.concatenate((links, np.zeros((~core_at).sum(), np.int64)))
            moved = np.flatnonzero((label != np.arange(len(label))) | (linked > 0))
            out_keys, out_links, out_roots = both[moved], linked[moved], both[label[moved]]
        return pa.table({"node": pa.array(out_keys, pa.int64()), "links": pa.array(out_links, pa.int64()), "root": pa.array(out_roots, pa.int64())})

    found = dealt.groupBy("cell", "a", "b").applyInArrow(join, "node bigint, links bigint, root bigint")
    found = materialize(found, "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    whole = nodes.select("node", "id", "count").join(links, "node", "left").join(groups, "node", "left")
    whole = whole.withColumn("component", F.coalesce("component", "node"))
    # The least id of a component's classes; classes of the component of a very common class are few beside rows.
    least = whole.groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("count"))
    named = join_counted(whole.select("node", "links", F.col("count").alias("size"), "component"), least, "component", n)
    named = named.select("node", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id", F.col("size").alias("count"))
    named = materialize(named, "vector-components")
    linked = join_counted(members, named, "node", members.count()).select("id", "n_links", "component_id")
    rest = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("values"))
    rest = rest.where(~usable_on("values") | F.col("id").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    done = linked.unionByName(rest)
    return done.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))


ORACLE = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) > 0 AS usable FROM embeddings),
units AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM vectors WHERE usable),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.9),
reach AS (
  SELECT vec_id, vec_id AS other FROM vectors
  UNION SELECT reach.vec_id, b FROM reach JOIN links ON a = other)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach GROUP BY vec_id
"""
