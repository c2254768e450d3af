import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from riskloom.functions.filters import FilterSpec
from riskloom.plans import metrics
from riskloom.plans.mart import MONTHLY_KEYS, monthly_sums, store_monthly, with_averages
from riskloom.sources import tables
from riskloom.sources.periods import PeriodStore
from riskloom.sources.versions import VersionLog


@pytest.fixture(scope="module")
def facts(spark):
    """Applications over ten months, some without a date, amount or product."""
    day = F.date_add(F.lit(dt.date(2025, 1, 5)), (F.col("id") * 7 % 300).cast("int"))
    return spark.range(3000).select(
        F.format_string("A%05d", F.col("id")).alias("application_id"),
        (F.col("id") % 100).alias("subject_id"),
        F.when(F.col("id") % 211 != 0, day).alias("app_date"),
        (F.col("id") % 5).cast("int").alias("region_code"),
        F.when(F.col("id") % 13 != 0, F.format_string("P%d", F.col("id") % 4)).alias("product_code"),
        (F.col("id") % 3).cast("int").alias("lender_code"),
        F.element_at(F.array(F.lit("web"), F.lit("shop")), (F.col("id") % 2 + 1).cast("int")).alias("channel"),
        F.when(F.col("id") % 17 != 0, (F.col("id") % 900).cast("decimal(18,0)")).alias("requested_amount"),
        (F.col("id") % 36).cast("decimal(5,0)").alias("tenor_months"),
        F.element_at(F.array(*map(F.lit, ("APPROVE", "REVIEW", "REJECT"))), (F.col("id") % 7 % 3 + 1).cast("int")).alias("decision"),
    )


def mart_rows(facts):
    """A mart of one table, with all that the monthly pre-aggregate reads."""
    return facts.select(
        "*", F.trunc("app_date", "month").alias("app_month"), F.year("app_date").alias("app_year"),
        F.col("region_code").cast("string").alias("region_name"), F.lit("i").alias("island_group"),
        F.col("product_code").alias("product_name"), F.lit("c").alias("product_class"), F.lit("t").alias("lender_type"),
        F.lit("Low").alias("risk_segment"), F.lit("b").alias("score_band"),
        F.when(F.col("decision") == "APPROVE", 1).otherwise(0).alias("is_approved"),
        (F.col("subject_id") / 100).alias("pd_probability"), F.col("subject_id").cast("int").alias("credit_score"),
        (F.col("subject_id") % 2).cast("int").alias("default_flag"),
    )


def same(left, right, digits=9):
    def rows(df):
        doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
        return sorted(map(str, df.withColumns({n: F.round(n, digits) for n in doubles}).select(*sorted(df.columns)).collect()))

    return rows(left) == rows(right)


def test_a_late_month_changes_one_folder(spark, facts, tmp_path):
    march = F.coalesce(F.trunc("app_date", "month") == F.lit(dt.date(2025, 3, 1)), F.lit(False))
    is_late = march & (F.col("subject_id") < 30)
    whole, early, late = mart_rows(facts), mart_rows(facts.where(~is_late)), mart_rows(facts.where(is_late))
    store = store_monthly(early, str(tmp_path / "m"))
    assert len(store.folders()) == 11 and any("HIVE_DEFAULT" in p for p in store.folders())
    assert store.add(monthly_sums(late)) == 1
    before, after = store.folders(0), store.folders(1)
    assert {p for p in after if after[p] != before[p]} == {"2025-03-01"}
    assert same(store.read(), monthly_sums(whole)) and same(store.read(0), monthly_sums(early))
    assert same(with_averages(store.read()), with_averages(monthly_sums(whole)))
    # Rows without a date are a period, too.
    undated = mart_rows(facts.where("app_date IS NULL"))
    store.add(monthly_sums(undated))
    assert {p for p in after if store.folders()[p] != after[p]} == {"__HIVE_DEFAULT_PARTITION__"}
    assert same(store.read(), monthly_sums(whole.unionByName(undated)))
    assert store.add(monthly_sums(undated.limit(0))) == 3 and store.folders(3) == store.folders(2)


def test_changed_months_are_built_anew_from_the_facts(facts, tmp_path):
    mart = mart_rows(facts)
    store = store_monthly(mart, str(tmp_path / "m"))
    corrected = mart.where("NOT (app_month = DATE'2025-04-01' AND subject_id > 50) AND app_month <> DATE'2025-06-01'")
    months = [dt.date(2025, 4, 1), dt.date(2025, 6, 1)]
    store.rebuild(months, lambda chosen: monthly_sums(corrected, chosen))
    before, after = store.folders(0), store.folders(1)
    assert set(before) - set(after) == {"2025-06-01"} and {p for p in after if after[p] != before[p]} == {"2025-04-01"}
    want = corrected.unionByName(mart.where("app_month IS NULL"))
    assert same(store.read(), monthly_sums(want))
    assert same(monthly_sums(mart, [None]), monthly_sums(mart.where("app_month IS NULL")))


def test_the_months_reach_the_scan_of_the_facts(spark, facts, tmp_path):
    facts.write.parquet(str(tmp_path / "f"))
    made = monthly_sums(mart_rows(spark.read.parquet(str(tmp_path / "f"))), [dt.date(2025, 4, 1)])
    assert "GreaterThanOrEqual(app_date,2025-04-01), LessThan(app_date,2025-05-01)" in made._jdf.queryExecution().executedPlan().toString()


def test_an_empty_store_and_wrong_keys(spark, facts, tmp_path):
    sums = monthly_sums(mart_rows(facts))
    store = PeriodStore.create(sums.limit(0), str(tmp_path / "e"), "app_month", MONTHLY_KEYS)
    assert store.read().count() == 0
    store.add(sums)
    assert same(store.read(), sums)
    with pytest.raises(ValueError, match="week"):
        PeriodStore.create(sums, str(tmp_path / "w"), "week", MONTHLY_KEYS)


@pytest.fixture(scope="module")
def rollup(facts, tmp_path_factory):
    table = metrics.application_metrics()
    return metrics.Rollup.build(facts, table, ["region", "product", "lender", "channel", "decision"], str(tmp_path_factory.mktemp("r")))


COVERED = [
    ([], None, None), (["product"], None, None), (["region", "channel"], "month", None), (["decision"], "quarter", None),
    ([], "year", FilterSpec(selections={"channel": ["web"], "region": []})),
    (["lender"], "month", FilterSpec(dt.date(2025, 3, 1), dt.date(2025, 5, 31), {"decision": ["APPROVE", "REJECT"]})),
    ([], None, FilterSpec(dt.date(2031, 1, 1))),
]


@pytest.mark.parametrize("dimensions, grain, filters", COVERED)
def test_every_covered_metric_is_the_same_from_both_sources(facts, rollup, dimensions, grain, filters):
    table = metrics.application_metrics()
    every = list(table.measures)
    for measures in [every, *[[m] for m in every[:2]]]:
        args = (facts, table, measures, dimensions, grain)
        stored = metrics.metric_query(*args, filters=filters, rollup=rollup)
        assert "id#" not in stored._jdf.queryExecution().optimizedPlan().toString()  # the facts are not read
        assert same(stored, metrics.metric_query(*args, filters=filters))


@pytest.mark.parametrize("dimensions, grain, filters", [
    (["subject_id"], "month", None), ([], "week", None), ([], "day", None),
    ([], None, FilterSpec(dt.date(2025, 3, 2))), ([], None, FilterSpec(None, dt.date(2025, 3, 30))),
    ([], None, FilterSpec(selections={"subject_id": [7]})),
])
def test_other_questions_go_to_the_facts(facts, rollup, dimensions, grain, filters):
    table = metrics.application_metrics()
    args = (facts, table, ["total_applications", "avg_tenor"], dimensions, grain)
    got = metrics.metric_query(*args, filters=filters, rollup=rollup)
    assert "id#" in got._jdf.queryExecution().optimizedPlan().toString()
    assert same(got, metrics.metric_query(*args, filters=filters))


def test_undeclared_names_are_refused(facts, rollup):
    table = metrics.application_metrics()
    for extra in ({"measures": ["nope"]}, {"dimensions": ["nope"]}, {"filters": FilterSpec(selections={"nope": [1]})}):
        with pytest.raises(ValueError, match="nope"):
            metrics.metric_query(facts, table, **({"measures": ["avg_tenor"]} | extra), rollup=rollup)


def test_a_rollup_takes_late_facts(facts, tmp_path):
    table = metrics.application_metrics()
    late = F.col("subject_id") % 9 == 0
    grown = metrics.Rollup.build(facts.where(~late), table, ["channel"], str(tmp_path / "r"))
    grown.add(facts.where(late))
    args = (facts, table, list(table.measures), ["channel"], "month")
    assert same(metrics.metric_query(*args, rollup=grown), metrics.metric_query(*args))


def test_versions_are_numbered_and_unfinished_ones_do_not_count(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path / "log"), "name string")
    assert log.newest() is None
    log.write([("a",)], 0)
    log.write([], 1)
    (tmp_path / "log" / "0000000007-unfinished").mkdir()
    fresh = VersionLog(spark, str(tmp_path / "log"), "name string")
    assert fresh.newest() == 1 and fresh.read(1) == [] and [r.name for r in fresh.read(0)] == ["a"]


def test_the_last_replacement_counts_whatever_the_clock_says(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        tables.replace_table(spark.range(n), path)
    assert tables.scan(spark, path).count() == 3


def test_products_of_grains_and_filters_are_covered_or_not(rollup):
    whole = FilterSpec(dt.date(2025, 1, 1), dt.date(2025, 12, 31))
    part = FilterSpec(dt.date(2025, 1, 1), dt.date(2025, 12, 30))
    for grain, filters in itertools.product(["month", "year", "week"], [None, whole, part]):
        assert rollup.covers(["avg_tenor"], ["region"], grain, filters) == (grain != "week" and filters is not part)
