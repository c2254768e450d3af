"""Physical plans: what is read, shuffled and broadcast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.functions.filters import FilterSpec
from riskloom.plans import tiles
from riskloom.plans.mart import ApplicationMart, mart_app_monthly
from riskloom.sources.tables import write_bucketed
from riskloom.sources.testtables import credit_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    t = credit_tables(spark, FOLDER)
    source = ApplicationMart(t.applications, t.region, t.product, t.lender, t.scores, t.subjects, [])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield source
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_mart_has_three_hash_exchanges_and_counted_broadcasts(mart):
    text = plan(mart.all_columns())
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("BroadcastExchange") == 3
    assert "BroadcastNestedLoop" not in text and "Cartesian" not in text


def test_volume_tile_reads_one_column_and_joins_nothing(mart):
    text = plan(tiles.tile("monthly_volume", mart))
    assert "Join" not in text and "ReadSchema: struct<app_date:date>" in text


def test_filters_reach_the_scan(mart):
    spec = FilterSpec(dt.date(1997, 1, 1), dt.date(1997, 3, 31), {"channel": ["1-URGENT"]})
    text = plan(tiles.tile("risk_mix", mart, spec))
    assert "GreaterThanOrEqual(app_date,1997-01-01)" in text and "EqualTo(channel,1-URGENT)" in text


def test_monthly_table_aggregates_before_its_shuffle(mart):
    text = plan(mart_app_monthly(mart))
    assert text.count("partial_count") >= 1
    assert text.count("Exchange hashpartitioning") == 4


def test_lookups_read_few_row_groups_and_one_region(spark, mart):
    t = credit_tables(spark, FOLDER)
    assert "PushedFilters: [IsNotNull(subject_id), EqualTo(subject_id,SUBJ000000042)]" in plan(t.lookup.where("subject_id = 'SUBJ000000042'"))
    one = plan(t.subjects_by_region.where("region_code = 'DKI'"))
    assert "PartitionFilters: [isnotnull(region_code" in one and "(region_code" in one
    files = t.lookup.groupBy(F.input_file_name()).agg(F.min("subject_id").alias("lo"), F.max("subject_id").alias("hi")).orderBy("lo").collect()
    assert all(a.hi < b.lo for a, b in zip(files, files[1:]))


def test_monthly_tiles_read_the_stored_table_alone(spark, mart):
    t = credit_tables(spark, FOLDER)
    for name, made in tiles.TILES.items():
        text = plan(tiles.tile(name, mart, monthly=t.monthly))
        assert ("mart-monthly" in text) == made.fits_monthly()
        assert not made.fits_monthly() or "Join" not in text
    assert not tiles.TILES["lender_performance"].fits_monthly()
    assert not tiles.TILES["risk_mix"].fits_monthly(FilterSpec(dt.date(1997, 1, 1)))
    assert tiles.TILES["risk_mix"].fits_monthly(FilterSpec(selections={"channel": ["1-URGENT"]}))


def test_a_changed_source_is_read_anew(spark, tmp_path):
    import shutil

    for name in ("nation", "region"):
        shutil.copyfile(f"{FOLDER}/{name}.parquet", tmp_path / f"{name}.parquet")
    assert credit_tables(spark, str(tmp_path)).region.count() == 25
    spark.read.parquet(f"{FOLDER}/nation.parquet").limit(5).toPandas().to_parquet(tmp_path / "nation.parquet")
    assert credit_tables(spark, str(tmp_path)).region.count() == 5


def test_bucketed_tables_join_without_a_shuffle(spark, mart, tmp_path):
    def stored(df, name):
        return write_bucketed(df, name, str(tmp_path / name), "subject_id", 4)

    try:
        co_located = ApplicationMart(
            stored(mart.applications, "apps_b"), mart.region, mart.product, mart.lender,
            stored(mart.scores, "scores_b"), stored(mart.features, "features_b"), [],
        )
        text = plan(co_located.all_columns())
        assert "Exchange hashpartitioning" not in text and text.count("SortMergeJoin") == 2
        assert co_located.all_columns().exceptAll(mart.all_columns()).count() == 0
    finally:
        for name in ("apps_b", "scores_b", "features_b"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
