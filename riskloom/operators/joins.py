"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize
from riskloom.sources.tables import KeyRanges

#: What may be sent to every executor, by counted rows and measured bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20
#: Rows of one key that one task may hold; a key with more is spread.
TASK_ROWS = 1_000_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether `df` holds at most `max_rows` rows and `max_bytes` bytes, measured as JSON text.

    Counting stops one row beyond.
    """
    width = F.octet_length(F.to_json(F.struct("*"))).cast("bigint")
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it is counted to be small, else unchanged: beyond the bound
    Catalyst and AQE choose a shuffled join."""
    return F.broadcast(df) if is_small(df, max_rows) else df


@dataclass(frozen=True)
class HotKeys:
    """Keys (NULL included) with more rows than a task should hold, and the salts each is spread over.

    `table` has columns key and salts; there are at most 1 / task_rows as many keys as rows.
    """

    table: DataFrame | None = None
    n: int = 0

    def __bool__(self) -> bool:
        return self.n > 0

    def joined(self, df: DataFrame, key: str) -> DataFrame:
        """`df` with the column `_salts`, 1 for keys that are not hot."""
        table = self.table.withColumnsRenamed({"key": "_hot_key", "salts": "_salts"})
        # A row of the table is a key and a number.
        table = F.broadcast(table) if self.n <= BROADCAST_ROWS else table
        found = df.join(table, df[key].eqNullSafe(table["_hot_key"]), "left").drop("_hot_key")
        return found.withColumn("_salts", F.coalesce("_salts", F.lit(1)))


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> HotKeys:
    """The keys of `df` with more than `task_rows` rows, by one count of one column."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    salts = F.ceil(F.col("n") / task_rows).cast("int").alias("salts")
    table = materialize(counts.where(F.col("n") > task_rows).select("key", salts), "hot-keys")
    return HotKeys(table, table.count())


def left_join_lookups(
    facts: DataFrame,
    lookups: list[DataFrame],
    key: str,
    row_key: str,
    hot: HotKeys | list | None = None,
) -> DataFrame:
    """Left-join several tables with unique `key` onto `facts`.

    Rows of a hot key are spread by a hash of `row_key` over as many salts as it has tasks' worth of
    rows, and the lookup row of that key (one per table) is repeated as often, so that no task holds
    more than its share of one key, however large the data. A hot NULL is spread too; it matches
    nothing. All joins share one join key, so `facts` is shuffled once. Without hot keys (`hot` an
    empty list says that there are none) it is a plain join.
    """
    hot = hot_keys(facts, key) if hot is None else hot
    if not hot:
        return reduce(lambda left, lookup: left.join(lookup, key, "left"), lookups, facts)
    spread = F.pmod(F.xxhash64(row_key), F.col("_salts")).cast("int")
    salted = hot.joined(facts, key).withColumn("_salt", spread).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    joined = reduce(
        lambda left, lookup: left.join(
            hot.joined(lookup, key).withColumn("_salt", copies).drop("_salts"), [key, "_salt"], "left"
        ),
        lookups,
        salted,
    )
    return joined.drop("_salt")


def left_join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    row_key: str,
    small: bool | None = None,
    hot: HotKeys | list | None = None,
) -> DataFrame:
    """Left-join a dimension with unique `key`: broadcast if it is counted to be small, else salted.

    `small` is the outcome of an earlier count, `hot` the hot keys if they are known.
    """
    if is_small(dimension) if small is None else small:
        return facts.join(F.broadcast(dimension), key, "left")
    return left_join_lookups(facts, [dimension], key, row_key, hot)


def attach_features(
    requests: DataFrame, features: DataFrame, key: str, row_key: str, hot: HotKeys | list | None = None
) -> DataFrame:
    """Requests with their features; a request whose key is unknown is dropped."""
    marked = features.withColumn("_found", F.lit(True))
    return left_join_lookups(requests, [marked], key, row_key, hot).where("_found").drop("_found")


def rows_with_keys(
    df: DataFrame, key: str, wanted: DataFrame | list, ranges: KeyRanges | None = None
) -> DataFrame:
    """Rows whose key is in a short list (pushed to the scan) or in another DataFrame (semi-join).

    Repeated keys are combined first, so a hot one costs nothing. With the key ranges of the table's
    files, only the files are read that may hold a wanted key, as far as the wanted keys are counted to
    be few (`BROADCAST_ROWS`, which the driver then holds); of very many keys, which would touch
    nearly all files, only the least and the greatest bound the scan.
    """
    if isinstance(wanted, list):
        part = ranges.part([k for k in wanted if k is not None]) if ranges else df
        return part.where(F.col(key).isin(wanted))
    keys = wanted.select(F.col(key).cast(df.schema[key].dataType)).where(F.col(key).isNotNull()).distinct()
    if ranges is None:
        return df.join(keys, key, "left_semi")
    keys = materialize(keys, "wanted-keys")
    n, low, high = keys.agg(F.count(key), F.min(key), F.max(key)).first()
    few = n <= BROADCAST_ROWS and is_small(keys)
    part = ranges.part([row[0] for row in keys.collect()]) if few else df
    bounded = part.where(F.col(key).between(F.lit(low), F.lit(high)))
    return bounded.join(F.broadcast(keys) if few else keys, key, "left_semi")


def upsert(
    base: DataFrame, changes: DataFrame, key: str, increments: tuple[str, ...] = ()
) -> DataFrame:
    """Apply a change set with unique keys: update known keys, add new ones.

    A NULL in a change keeps the stored value; the columns in `increments` are added to it.
    Changes may carry a subset of the columns. One shuffle per side, one full outer join.
    """
    old = base.select(F.col(key), F.struct(*[c for c in base.columns if c != key]).alias("old"))
    given = [c for c in changes.columns if c != key]
    new = changes.select(F.col(key), F.struct(*given).alias("new"))
    merged = old.join(new, key, "full_outer")

    def value(name: str) -> Column:
        if name == key:
            return F.col(key)
        before = F.col(f"old.{name}")
        if name not in given:
            return before.alias(name)
        after = F.col(f"new.{name}")
        if name in increments:
            summed = F.coalesce(before, F.lit(0)) + after
            return F.coalesce(summed, before).cast(base.schema[name].dataType).alias(name)
        return F.coalesce(after, before).cast(base.schema[name].dataType).alias(name)

    return merged.select(*[value(c) for c in base.columns])
