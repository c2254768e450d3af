import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift
from riskloom.operators.joins import upsert
from riskloom.operators.upserts import BucketedTable
from riskloom.sources.periods import PeriodStore
from riskloom.streaming import jobs


@pytest.fixture
def events(spark, tmp_path):
    """Three files of requests over six days; a third of them from one subject."""
    folder = str(tmp_path / "events")
    df = spark.range(900).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int").alias("subject_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int) div 7, 0, 0)").alias("at"),
        (F.col("id") % 11).cast("double").alias("value"),
    )
    for part in range(3):
        df.where(f"event_id div 300 = {part}").coalesce(1).write.mode("append").parquet(folder)
    return folder, df


def stream(spark, folder, df, files=1):
    return jobs.table_stream(spark, folder, df.schema, files_per_batch=files)


def test_scored_log_equals_the_batch_result(spark, events, tmp_path):
    folder, df = events
    features = spark.range(40).select(F.col("id").cast("int").alias("subject_id"), (F.col("id") / 40).alias("p"))
    state, sink = str(tmp_path / "state"), str(tmp_path / "log")
    requests = stream(spark, folder, df).select("event_id", "subject_id")
    log = jobs.stream_score(requests, features, "subject_id", "event_id", F.col("p"), state, sink)
    batch = jobs.score_requests(df.select("event_id", "subject_id"), features, "subject_id", "event_id", F.col("p"))
    assert log.count() == 900
    assert log.exceptAll(batch).count() == 0
    unknown = log.where("subject_id >= 40").select("pd_probability", "decision").distinct().collect()
    assert [tuple(r) for r in unknown] == [(None, None)]
    again = jobs.stream_score(
        stream(spark, folder, df).select("event_id", "subject_id"), features, "subject_id", "event_id",
        F.col("p"), state, sink,
    )
    assert again.count() == 900


def test_streamed_drift_equals_the_batch_result(spark, events, tmp_path):
    folder, df = events
    baseline = df.where("event_id < 200")
    got = jobs.stream_drift(
        stream(spark, folder, df), baseline, "at", "value", str(tmp_path / "s"), str(tmp_path / "o"),
        lateness="30 days",
    )
    want = drift.difference_of_means(df, baseline, "at", ["value"], dt.date(2024, 1, 8))
    key = lambda r: (r.day, r.n, round(r.mean, 9), round(r.difference, 9))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_feature_refresh_equals_one_upsert(spark, events, tmp_path):
    folder, df = events
    base = spark.range(45).select(
        F.col("id").cast("int").alias("subject_id"), F.lit(0.0).alias("largest"), F.lit(0).cast("bigint").alias("n")
    )

    def summarise(batch):
        return batch.groupBy("subject_id").agg(F.max("value").alias("largest"), F.count("*").alias("n"))

    got = jobs.stream_feature_refresh(
        stream(spark, folder, df), summarise, base, "subject_id", ("n",), str(tmp_path / "s"), str(tmp_path / "v")
    )
    want = upsert(base, summarise(df), "subject_id", ("n",))
    assert got.count() == 50
    assert got.select("subject_id", "n").exceptAll(want.select("subject_id", "n")).count() == 0


def test_a_batch_does_not_shuffle_the_features(spark, tmp_path):
    path = str(tmp_path / "features")
    spark.range(50_000).select(F.col("id").cast("int").alias("subject_id"), F.rand(1).alias("p")).write.parquet(path)
    requests = spark.range(20).select(F.col("id").alias("event_id"), F.col("id").cast("int").alias("subject_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scored = jobs.score_requests(requests, spark.read.parquet(path), "subject_id", "event_id", F.col("p"))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
        depth = lines[scan].index("FileScan")
        above = [line for line in lines[:scan] if len(line) - len(line.lstrip(" :+-*()0123456789")) < depth]
        assert "Exchange hashpartitioning" not in "".join(line for line in above if "Exchange" in line and "Broadcast" not in line)
        assert scored.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def table_rows(table, version=None):
    return {tuple(r) for r in table.read(version).collect()}


def test_an_upsert_reads_and_writes_only_the_buckets_it_touches(spark, tmp_path):
    base = spark.range(5000).select("id", F.lit(1).cast("bigint").alias("n"), F.lit("s").alias("s"))
    table = BucketedTable.create(base, str(tmp_path / "t"), "id", 300)
    # The type of a change's key need not be that of the table.
    changes = spark.createDataFrame([(17, 4), (90_000, 9)], "id int, n long")
    before = table.manifest(0)
    assert table.upsert(changes, ("n",)) == 1
    after = table.manifest(1)
    written = set(after) - set(before)
    assert 1 <= len(set(before) - set(after)) <= 2 and written
    folders = {b.folder.split("/")[0] for b in written}
    stored = [spark.read.parquet(str(tmp_path / "t" / "data" / f)) for f in folders]
    assert sum(df.count() for df in stored) == sum(b.rows for b in written) < 700
    want = upsert(base, changes.withColumn("id", F.col("id").cast("long")), "id", ("n",))
    assert table_rows(table) == {tuple(r) for r in want.collect()} and table.read().count() == 5001
    assert table_rows(table, 0) == {tuple(r) for r in base.collect()}
    assert table.upsert(changes.limit(0)) == 2 and table.read().count() == 5001
    empty = BucketedTable.create(base.limit(0), str(tmp_path / "e"), "id", 4)
    assert empty.read().count() == 0 and empty.lookup(changes).count() == 0
    empty.upsert(changes, ("n",))
    assert empty.read().count() == 2


def test_a_table_that_grows_fifty_times_keeps_its_buckets_small(spark, tmp_path):
    def rows(first, last):
        return spark.range(first, last).select("id", (F.col("id") % 7).alias("n"))

    table = BucketedTable.create(rows(0, 1000), str(tmp_path / "t"), "id", 500)
    assert {b.depth for b in table.manifest(0)} <= {2, 3}
    size = 1000
    for grown in (3000, 9000, 20_000, 50_000):
        version = table.upsert(rows(size, grown))
        size = grown
        buckets = table.manifest(version)
        assert sum(b.rows for b in buckets) == size and max(b.rows for b in buckets) <= 500
        # Buckets do not overlap: each prefix is no other's beginning.
        ends = sorted((b.prefix << 62 - b.depth, b.prefix + 1 << 62 - b.depth) for b in buckets)
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert table.read().exceptAll(rows(0, 50_000)).count() == 0 and table.read().count() == 50_000
    few = table.upsert(rows(10, 12))
    assert len(set(table.manifest(few)) - set(table.manifest(few - 1))) <= 2 * 2
    # Another reader finds the same table from its files.
    other = BucketedTable(spark, table.root, "id", table.schema, 500)
    assert other.newest() == few and set(other.manifest(few)) == set(table.manifest(few))


def test_a_version_written_again_replaces_nothing_that_is_read(spark, tmp_path):
    table = BucketedTable.create(spark.range(100).select("id", F.lit(0).alias("n")), str(tmp_path / "t"), "id", 1000)
    changes = spark.createDataFrame([(5, 1)], "id long, n int")
    table.upsert(changes, ("n",), 0)
    first = table.read(1)
    files = set(first.inputFiles())
    table.upsert(changes, ("n",), 0)
    assert first.where("n = 1").count() == 1 and set(first.inputFiles()) == files
    fresh = BucketedTable(spark, table.root, "id", table.schema, 1000)
    assert fresh.newest() == 1 and fresh.read().where("n = 1").count() == 1


def test_a_lookup_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    df = spark.range(20_000).select("id", (F.col("id") * 2).alias("v"))
    table = BucketedTable.create(df, str(tmp_path / "t"), "id", 400)
    assert len(table.manifest(0)) >= 50
    wanted = spark.createDataFrame([(3,), (3,), (777,), (99_999,), (None,)], "id int")
    found = table.lookup(wanted)
    assert sorted(map(tuple, found.collect())) == [(3, 6), (777, 1554)]
    assert len(found.inputFiles()) <= 3
    assert "PushedFilters: [In(id" in found._jdf.queryExecution().executedPlan().toString()
    many = spark.range(5000).select(F.col("id") * 3)
    assert table.lookup(many.toDF("id")).count() == 5000


def test_a_scored_batch_reads_only_the_buckets_of_its_subjects(spark, tmp_path):
    features = spark.range(20_000).select(F.col("id").cast("int").alias("subject_id"), (F.col("id") / 40_000).alias("p"))
    table = BucketedTable.create(features, str(tmp_path / "t"), "subject_id", 400)
    requests = spark.createDataFrame([(1, 5), (2, 5), (3, 19_999), (4, -1)], "event_id long, subject_id int")
    got = jobs.score_requests(requests, table, "subject_id", "event_id", F.col("p"))
    want = jobs.score_requests(requests, features, "subject_id", "event_id", F.col("p"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    read = [f for f in got.inputFiles() if str(tmp_path) in f]
    assert 1 <= len(read) <= 3 and len(table.manifest(0)) >= 50


def test_performance_per_day(spark):
    df = spark.createDataFrame(
        [("2024-01-01", 0.9, 1), ("2024-01-01", 0.2, 0), ("2024-01-01", 0.8, 0), ("2024-01-02", 0.9, 1),
         ("2024-01-02", 0.1, None)],
        "day_text string, p double, y int",
    ).withColumn("at", F.col("day_text").cast("timestamp_ntz"))
    rows = drift.performance_by_day(df, "at", "p", "y").orderBy("day").collect()
    assert (rows[0].n, rows[0].accuracy, rows[0].auc) == (3, pytest.approx(2 / 3), 1.0)
    assert (rows[1].n, rows[1].accuracy, rows[1].auc) == (1, 1.0, None)


def test_streamed_performance_is_corrected_as_outcomes_come(spark, tmp_path):
    made = spark.range(600).select(
        F.col("id"), F.expr("timestamp_ntz'2024-01-01 06:00:00' + make_dt_interval(cast(id % 6 as int))").alias("at"),
        (F.col("id") * 7919 % 97 / 97).alias("p"),
    )
    known = made.where("id % 11 <> 0").select(
        "id", F.expr("at + make_dt_interval(cast(id % 5 as int), 3)").alias("known_at"), ((F.col("id") * 31) % 7 < 3).cast("int").alias("y")
    )
    too_late = made.where("id % 11 = 0").select("id", F.expr("at + make_dt_interval(40)").alias("known_at"), F.lit(1).alias("y"))
    folders = {name: str(tmp_path / name) for name in ("made", "known")}
    for part in range(3):
        made.where(f"id div 200 = {part}").coalesce(1).write.mode("append").parquet(folders["made"])
        known.where(f"id % 5 {['= 0', 'between 1 and 2', '> 2'][part]}").coalesce(1).write.mode("append").parquet(folders["known"])
    too_late.coalesce(1).write.mode("append").parquet(folders["known"])
    store = str(tmp_path / "store")

    def run():
        return jobs.stream_performance(
            stream(spark, folders["made"], made), stream(spark, folders["known"], known), "id", "at", "known_at", "p", "y",
            str(tmp_path / "state"), store, lateness="90 days",
        )

    def rows(df):
        return sorted((str(r.day), r.n, round(r.accuracy, 9), round(r.auc, 9)) for r in df.collect())

    want = rows(drift.performance_by_day(made.join(known, "id"), "at", "p", "y"))
    assert rows(run()) == want and len(want) == 6
    # The counts grew batch by batch, and a day that a batch does not touch stays as it is.
    versions = PeriodStore(spark, store, "day", ("day", "score"), None)
    assert versions.log.newest() >= 3
    sizes = [len(versions.folders(v)) for v in range(versions.log.newest() + 1)]
    assert sizes[0] == 0 and sizes == sorted(sizes) and sizes[-1] == 6


def test_rows_beyond_the_lateness_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "late")
    first = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-09", 5.0)], "day string, value double")
    second = spark.createDataFrame([("2024-01-09", 6.0)], "day string, value double")
    late = spark.createDataFrame([("2024-01-01", 9.0), ("2024-01-09", 7.0)], "day string, value double")
    for part in (first, second, late):
        part.withColumn("at", F.col("day").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    got = jobs.stream_drift(
        jobs.table_stream(spark, folder, schema, files_per_batch=1), spark.read.parquet(folder), "at",
        "value", str(tmp_path / "s"), str(tmp_path / "o"),
    )
    means = {str(r.day): r.n for r in got.collect()}
    assert means == {"2024-01-01": 1, "2024-01-09": 3}
