import os
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import joins
from riskloom.operators.joins import (
    attach_features,
    broadcast_if_small,
    hot_keys,
    is_small,
    left_join_dimension,
    left_join_lookups,
    rows_with_keys,
    upsert,
)
from riskloom.sources.tables import KeyRanges, write_clustered


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, a tenth without a key."""
    rng = random.Random(1)
    data = []
    for i in range(6000):
        roll = rng.random()
        key = 7 if roll < 0.34 else None if roll < 0.44 else rng.randrange(3000)
        data.append((i, key))
    return spark.createDataFrame(data, "row_id int, k int")


@pytest.fixture
def lookup(spark):
    return spark.range(0, 2500).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))


def salts_of(hot):
    return {row["key"]: row["salts"] for row in hot.table.collect()}


def test_hot_keys_finds_the_heavy_key_and_null_only(skewed):
    counts = {row.k: row["count"] for row in skewed.groupBy("k").count().collect()}
    found = salts_of(hot_keys(skewed, "k", 100))
    assert found == {7: -(-counts[7] // 100), None: -(-counts[None] // 100)}
    assert set(salts_of(hot_keys(skewed, "k", 1000))) == {7}
    assert not hot_keys(skewed, "k")
    assert not hot_keys(skewed.where("row_id < 0"), "k", 0)


def test_no_task_gets_more_than_its_share_of_hot_keys(spark):
    """One key with 30 % of the rows, and many with 0.5 %."""
    df = spark.range(20_000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 10 < 3, -1).otherwise(F.col("id") % 140).cast("int").alias("k"),
    )
    lookup = spark.range(-1, 140).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        joined = left_join_lookups(df, [lookup], "k", "row_id", hot_keys(df, "k", 60))
        assert joined.count() == 20_000 and joined.where("v != k").count() == 0
        sizes = joined.groupBy(F.spark_partition_id().alias("p"), "k").count()
        assert sizes.agg(F.max("count")).first()[0] <= 4 * 60
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_salted_join_equals_plain_join(spark, skewed, lookup):
    other = lookup.select("k", F.lit("x").alias("w")).where("k % 2 = 1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        salted = left_join_lookups(skewed, [lookup, other], "k", "row_id", hot=hot_keys(skewed, "k", 100))
        plain = skewed.join(lookup, "k", "left").join(other, "k", "left")
        columns = ["row_id", "k", "v", "w"]
        assert sorted(map(str, salted.select(columns).collect())) == sorted(
            map(str, plain.select(columns).collect())
        )
        spread = (
            left_join_lookups(
                skewed.select("row_id", "k"), [lookup], "k", "row_id", hot=hot_keys(skewed, "k", 100)
            )
            .where("k = 7")
            .select(F.spark_partition_id().alias("p"))
            .distinct()
            .count()
        )
        assert spread > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_salted_join_shuffles_the_facts_once(spark, skewed, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        other = lookup.withColumnRenamed("v", "w")
        joined = left_join_lookups(skewed, [lookup, other], "k", "row_id", hot=hot_keys(skewed, "k", 1000))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_large_dimension_is_salted_instead_of_broadcast(skewed, lookup):
    small = left_join_dimension(skewed, lookup, "k", "row_id")
    large = left_join_dimension(skewed, lookup, "k", "row_id", small=False)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().logical().toString().lower()
    assert small.exceptAll(large.select(small.columns)).count() == 0


def test_broadcast_needs_a_counted_size(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(broadcast_if_small(spark.range(10), 10))
    assert not hinted(broadcast_if_small(spark.range(11), 10))
    wide = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("x"))
    assert is_small(wide, 10, 4000) and not is_small(wide, 10, 2000)


def test_unknown_requests_are_dropped(skewed, lookup):
    joined = attach_features(skewed, lookup, "k", "row_id")
    assert joined.count() == skewed.where("k < 2500").count()
    assert joined.where("v != k * 10").count() == 0


def test_key_lookup_by_list_and_by_table(spark, lookup):
    assert rows_with_keys(lookup, "k", [1, 5, 9999]).count() == 2
    wanted = spark.createDataFrame([(1,), (1,), (5,)], "k int")
    assert rows_with_keys(lookup, "k", wanted).count() == 2


def test_a_lookup_reads_only_the_files_of_its_keys(spark, tmp_path):
    df = spark.range(10_000).select(F.format_string("K%06d", F.col("id")).alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 4).alias("v"))
    stored = write_clustered(df, str(tmp_path / "t"), "k", 20)
    ranges = KeyRanges.of(stored, "k")
    assert len(ranges.files) == 20 and list(ranges.lows) == sorted(ranges.lows)
    size = {f: os.path.getsize(f.removeprefix("file://")) for f in ranges.files}
    keys = ["K000003", "K000004", "K005000", "K999999", "a"]
    wanted = spark.createDataFrame([(k,) for k in [*keys, "K000003", None]], "k string")
    for found in (rows_with_keys(stored, "k", wanted, ranges), rows_with_keys(stored, "k", keys, ranges)):
        assert sorted(r.k for r in found.collect()) == keys[:3]
        read = set(found.inputFiles()) & set(size)
        assert 2 <= len(read) <= 3 and sum(size[f] for f in read) < 0.2 * sum(size.values())
    every = rows_with_keys(stored, "k", df.select("k").where("k >= 'K000010'"), ranges)
    assert every.count() == 9990
    assert rows_with_keys(stored, "k", wanted.limit(0), ranges).count() == 0
    assert rows_with_keys(stored, "k", ["a"], ranges).count() == 0


def test_very_many_wanted_keys_bound_the_scan(spark, tmp_path, monkeypatch):
    stored = write_clustered(spark.range(1000), str(tmp_path / "t"), "id", 5)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    found = rows_with_keys(stored, "id", spark.range(500, 700).union(spark.range(5000, 5010)), KeyRanges.of(stored, "id"))
    assert found.count() == 200
    assert "GreaterThanOrEqual(id,500)" in found._jdf.queryExecution().executedPlan().toString()


def test_upsert_updates_inserts_and_keeps(rows):
    base = rows("id int, u double, n int, s string", (1, 0.5, 3, "a"), (2, 0.7, None, "b"), (3, 0.1, 1, "c"))
    changes = rows("id int, u double, n int", (1, 0.42, 1), (2, None, 2), (9, 0.9, 5))
    got = {r.id: tuple(r)[1:] for r in upsert(base, changes, "id", ("n",)).collect()}
    assert got == {1: (0.42, 4, "a"), 2: (0.7, 2, "b"), 3: (0.1, 1, "c"), 9: (0.9, 5, None)}


def test_upsert_without_increments_is_idempotent(rows):
    base = rows("id int, u double", (1, 0.5), (2, 0.7))
    changes = rows("id int, u double", (2, 0.9), (3, 0.1))
    once = upsert(base, changes, "id")
    twice = upsert(once, changes, "id")
    assert sorted(once.collect()) == sorted(twice.collect())
