"""Running totals, exact order statistics and exact samples without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskloom.functions.hashing import md5_int
from riskloom.operators.joins import broadcast_if_small, left_join_lookups
from riskloom.session import materialize

#: Leading hash bits by which a sample finds its last row; the rows of one such bucket are ranked.
SAMPLE_BITS = 18


def running_totals(
    df: DataFrame, value: str, totals: list[str], groups: list[str], ranges: int | None = None
) -> DataFrame:
    """Add `<t>_before` (sum over smaller values of the group) and `<t>_total` (sum of the group).

    `df` holds one row per group and value. It is cut into ranges of (group, value) by Spark's range
    partitioning, which samples the cuts once and finds a row's range by binary search; a large group
    spreads over many ranges and small ones share a range. The rows are stored with their range, so that
    the sums of the ranges and the rows belong to the same cuts. Each range then starts from a head row
    that holds what came before it, and one window runs inside each range.

    `ranges` is the number of ranges; without it Spark makes as many as a shuffle has partitions and
    joins small ones.
    """
    rows = df.withColumn("_key", F.struct(*groups) if groups else F.lit(0))
    order = ["_key", value] if groups else [value]
    spread = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    ranged = materialize(spread.withColumn("_range", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("_key", "_range").agg(*[F.sum(t).alias(t) for t in totals])
    earlier = W.partitionBy("_key").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    heads = sums.select(
        "_key",
        "_range",
        F.lit(False).alias("_row"),
        *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_{t}") for t in totals],
        *[F.sum(t).over(W.partitionBy("_key")).alias(f"{t}_total") for t in totals],
    )
    amounts = [F.col(t).alias(f"_{t}") for t in totals]
    together = ranged.select("*", F.lit(True).alias("_row"), *amounts).unionByName(heads, allowMissingColumns=True)
    inside = W.partitionBy("_key", "_range").orderBy("_row", value)
    placed = together.withColumns(
        {f"{t}_before": F.sum(f"_{t}").over(inside.rowsBetween(W.unboundedPreceding, -1)) for t in totals}
        | {f"{t}_total": F.first(f"{t}_total").over(inside.rowsBetween(W.unboundedPreceding, 0)) for t in totals}
    )
    return placed.where("_row").select(*df.columns, *[f"{t}_{part}" for t in totals for part in ("before", "total")])


def value_counts(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    """Number of rows per group and non-NULL value, combined on the map side."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _nearest_index(percent: float, n: Column) -> Column:
    """0-based index of the nearest rank; halves go to the even index."""
    return F.bround(F.lit(percent / 100.0) * (n - 1)).cast("bigint")


def order_statistics(
    df: DataFrame,
    value: str,
    percents: dict[str, float],
    groups: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Per group: row count `n`, exact nearest-rank percentiles by name, and the exact `median`."""
    groups = groups or []
    placed = running_totals(value_counts(df, value, groups), value, ["n"], groups, ranges)
    total, before, own = F.col("n_total"), F.col("n_before"), F.col("n")

    def at(index: Column) -> Column:
        return F.max(F.when((before <= index) & (index < before + own), F.col(value)))

    lower = F.floor((total - 1) / 2)
    upper = F.ceil((total - 1) / 2)
    return placed.groupBy(*groups).agg(
        F.max(total).alias("n"),
        *[at(_nearest_index(p, total)).alias(name) for name, p in percents.items()],
        ((at(lower) + at(upper)) / 2.0).alias("median"),
    )


def smallest_hash_rows(
    df: DataFrame,
    key: str,
    salt: str,
    n: int | None = None,
    strata: str | None = None,
    fraction: float | None = None,
    bits: int = SAMPLE_BITS,
) -> DataFrame:
    """The rows with the smallest hashes of a unique key: exactly `n`, or a rounded `fraction` of each
    stratum, of which there may be any number.

    A histogram over the leading hash bits finds, per stratum, the bucket in which the quota is
    reached; the rows of that bucket are ranked to find the last (hash, key) that is wanted. Both read
    two columns of the input. The wide rows are then read once and filtered: by that last row, or, with
    strata, by the stored table of last rows, which is broadcast if it is counted to be small and else
    joined with hot strata spread.
    """
    stratum = F.coalesce(F.col(strata).cast("string"), F.lit("")) if strata else F.lit("")
    missing = F.col(strata).isNull() if strata else F.lit(False)
    group = F.struct(stratum.alias("value"), missing.alias("missing"))
    hashed = F.struct(md5_int(F.col(key), salt).alias("h"), F.col(key).alias("k"))
    thin = df.select(group.alias("_group"), hashed.alias("_at"))
    bucket = F.shiftright("_at.h", 32 - bits)
    counts = thin.groupBy("_group", bucket.alias("edge")).agg(F.count(F.lit(1)).alias("own"))
    whole = W.partitionBy("_group")
    before = F.coalesce(F.sum("own").over(whole.orderBy("edge").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumns({"total": F.sum("own").over(whole), "before": before})
    quota = F.lit(n) if n is not None else F.round(F.lit(fraction) * F.col("total")).cast("bigint")
    counts = counts.withColumn("needed", F.least(quota, "total") - F.col("before"))
    edges = counts.where("needed > 0 AND needed <= own").select("_group", "edge", "needed")
    inside = thin.withColumn("edge", bucket).join(edges, ["_group", "edge"])
    ranked = inside.withColumn("_rank", F.row_number().over(whole.orderBy("_at")))
    last = ranked.where(F.col("_rank") == F.col("needed")).select("_group", F.col("_at").alias("_last"))
    if strata is None:
        # One stratum: the last row is a scalar, and planning it starts no job.
        return df.where(hashed <= last.agg(F.first("_last")).scalar())
    limits = materialize(last, "sample-limits")
    few = broadcast_if_small(limits)
    grouped = df.withColumn("_group", group)
    if few is not limits:
        found = grouped.join(few, "_group", "left")
    else:
        found = left_join_lookups(grouped, [limits], "_group", key)
    return found.where(hashed <= F.col("_last")).select(*df.columns)


def hash_split(df: DataFrame, key: str, fraction: float, salt: str) -> tuple[DataFrame, DataFrame]:
    """Split by key hash: about `fraction` of the keys on the left, the same ones on every run."""
    threshold = int(fraction * 2**32)
    left = md5_int(F.col(key), salt) < threshold
    return df.where(left), df.where(~left)
