import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.functions.filters import FilterSpec
from riskloom.functions.hashing import fast_uniform
from riskloom.plans import metrics, tiles, trends
from riskloom.plans.features import FeatureView, credit_bureau_features, dataset_snapshot, training_set
from riskloom.operators.joins import hot_keys
from riskloom.plans.mart import (
    MART_COLUMNS,
    MONTHLY_KEYS,
    ApplicationMart,
    mart_app_monthly,
    score_results,
)
from riskloom.sources.synthetic import generate_subjects


@pytest.fixture(scope="module")
def parts(spark):
    day = dt.date
    applications = spark.createDataFrame(
        [
            ("A1", "s1", day(2025, 1, 15), "R1", "P1", "L1", "Web", 100, 12, "APPROVE"),
            ("A2", "s1", day(2025, 1, 20), "R1", "P1", "L1", "Web", 200, 12, "REJECT"),
            ("A3", "s2", day(2025, 3, 2), "R9", "P9", "L9", "Branch", 300, 24, "APPROVE"),
            ("A4", "s9", day(2025, 3, 3), "R1", None, None, "Web", 400, None, None),
            ("A5", None, day(2025, 3, 9), "R1", "P1", "L1", "Web", 500, 6, "APPROVE"),
        ],
        "application_id string, subject_id string, app_date date, region_code string, product_code string, "
        "lender_code string, channel string, requested_amount int, tenor_months int, decision string",
    )
    region = spark.createDataFrame([("R1", "One", "Jawa")], "region_code string, region_name string, island_group string")
    product = spark.createDataFrame([("P1", "Card", "Unsecured")], "product_code string, product_name string, product_class string")
    lender = spark.createDataFrame([("L1", "Bank A", "Bank")], "lender_code string, lender_name string, lender_type string")
    subjects = spark.createDataFrame(
        [("s1", 0.05, 0, 10.0, 30, 0.2), ("s2", 0.40, 1, 20.0, 40, 0.9)],
        "subject_id string, pd double, default_flag int, monthly_income double, age int, credit_utilization double",
    )
    scores = score_results(subjects.where("subject_id = 's1'"), F.col("pd"), scored_at="2025-01-01 00:00:00")
    return applications, region, product, lender, scores, subjects


@pytest.fixture(scope="module")
def mart(parts):
    return ApplicationMart(*parts).all_columns()


def test_mart_keeps_every_application(mart):
    assert sorted(r.application_id for r in mart.collect()) == ["A1", "A2", "A3", "A4", "A5"]
    assert len(mart.columns) == 28


def test_missing_score_is_excellent_and_high(mart):
    row = mart.where("application_id = 'A3'").first()
    assert (row.score_band, row.risk_segment, row.pd_probability) == ("5_Excellent", "High", None)
    assert row.default_flag == 1


def test_unknown_codes_become_null(mart):
    row = mart.where("application_id = 'A3'").first()
    assert (row.region_code, row.product_code, row.lender_code, row.island_group) == (None,) * 4


def test_decision_is_the_applications(mart):
    rows = {r.application_id: r for r in mart.collect()}
    assert rows["A2"].decision == "REJECT" and rows["A2"].risk_segment == "Low"
    assert rows["A4"].is_approved == 0 and rows["A1"].is_approved == 1
    assert rows["A1"].app_month == dt.date(2025, 1, 1) and rows["A1"].app_week == dt.date(2025, 1, 13)


def test_hot_subject_gives_the_same_mart(parts, mart):
    salted = ApplicationMart(*parts, hot=hot_keys(parts[0], "subject_id", 1)).all_columns()
    assert sorted(map(str, salted.collect())) == sorted(map(str, mart.collect()))


def test_monthly_totals_equal_the_mart(mart):
    monthly = mart_app_monthly(mart)
    assert monthly.agg(F.sum("n_applications")).first()[0] == mart.count()
    assert monthly.agg(F.sum("total_requested")).first()[0] == 1500
    assert set(MONTHLY_KEYS) < set(monthly.columns)


def test_filtered_tile_and_open_filter(mart):
    jawa = FilterSpec(selections={"island_group": ["Jawa"], "channel": []})
    assert tiles.tile("kpi_total_applications", mart, jawa).first()[0] == 4
    assert tiles.tile("kpi_total_applications", mart, FilterSpec()).first()[0] == 5


def test_shares_add_up(mart):
    mix = tiles.decision_mix_by_channel(mart).groupBy("channel").agg(F.sum("share_pct").alias("s"))
    assert all(abs(r.s - 100) < 0.01 for r in mix.collect())
    assert abs(tiles.channel_share(mart).agg(F.sum("share_pct")).first()[0] - 100) < 0.01


def test_kpi_delta_over_two_periods(mart):
    march = FilterSpec(dt.date(2025, 3, 1), dt.date(2025, 3, 31))
    january = FilterSpec(dt.date(2025, 1, 1), dt.date(2025, 1, 31))
    row = tiles.kpi_delta(mart, march, january).first()
    assert (row.total_applications_current, row.total_applications_prior, row.total_applications_delta) == (3, 2, 1)
    assert row.approval_rate_pct_delta == pytest.approx(16.7)


def test_funnel_lists_absent_stages(parts):
    rows = trends.decision_funnel(parts[0]).orderBy("stage_order").collect()
    assert [(r.stage, r.applications) for r in rows] == [("APPROVE", 3), ("REVIEW", 0), ("REJECT", 1)]
    assert rows[0].pct_of_first == 100.0
    none = trends.decision_funnel(parts[0].where("decision = 'REJECT'")).collect()
    assert all(r.pct_of_first is None for r in none)


def test_empty_months_and_weeks_are_listed(parts):
    months = trends.period_trend(parts[0]).collect()
    assert [(str(r.period), r.total, r.approved) for r in months] == [
        ("2025-01-01", 2, 1), ("2025-02-01", 0, 0), ("2025-03-01", 3, 2)
    ]
    assert months[1].avg_amount is None and months[1].approval_rate is None
    weeks = trends.period_trend(parts[0], "week").collect()
    assert [str(r.period) for r in weeks] == [
        "2025-01-19", "2025-01-26", "2025-02-02", "2025-02-09", "2025-02-16", "2025-02-23",
        "2025-03-02", "2025-03-09",
    ]
    assert [r.total for r in weeks] == [1, 1, 0, 0, 0, 0, 1, 2]


def test_crosstab_margins(parts):
    rows = {r.region_code: r.asDict() for r in trends.crosstab(parts[0], "region_code", "decision", ["APPROVE", "REVIEW", "REJECT"]).collect()}
    assert rows["All"]["All"] == 4 and rows["R9"]["REVIEW"] == 0
    assert rows["All"]["APPROVE"] == rows["R1"]["APPROVE"] + rows["R9"]["APPROVE"] == 3
    learned = trends.crosstab(parts[0], "region_code", "decision")
    assert learned.columns == ["region_code", "APPROVE", "REJECT", "All"]


def test_histogram_keeps_every_row(spark, rows):
    df = spark.range(1000).select((fast_uniform("id", "p") ** 2).alias("p"), (F.col("id") % 2).alias("y"))
    out = trends.histogram(df, "p", "y")
    assert out.agg(F.sum("n"), F.min("bin"), F.max("bin")).first()[:] == (1000, 0, 49)
    flat = trends.histogram(rows("p double, y int", (0.5, 1), (0.5, 0), (None, 1)), "p", "y")
    assert [(r.bin, r.n) for r in flat.collect()] == [(0, 1), (0, 1)]


def test_cards_of_both_tables(parts):
    row = trends.kpi_cards(parts[0], parts[5]).first()
    assert (row.total_applications, row.avg_amount, row.default_rate, row.avg_income) == (5, 300.0, 0.5, 15.0)


def test_metric_query_checks_its_names(parts):
    table = metrics.application_metrics()
    out = metrics.metric_query(parts[0], table, ["total_applications", "approval_rate"], ["channel"], "month")
    got = {(r.channel, str(r.period)): (r.total_applications, r.approval_rate) for r in out.collect()}
    assert got[("Web", "2025-01-01")] == (2, 0.5)
    with pytest.raises(ValueError):
        metrics.metric_query(parts[0], table, ["margin"])
    with pytest.raises(ValueError):
        metrics.metric_query(parts[5], metrics.subject_metrics(), ["total_subjects"], grain="month")


def test_contributions_add_up_to_the_change(mart):
    rows = metrics.approval_change(
        mart.withColumn("app_date", F.when(F.col("app_month") == "2025-01-01", F.lit(dt.date(2024, 12, 1))).otherwise(F.col("app_date"))),
        dt.date(2025, 2, 1), "channel",
    ).collect()
    assert sum(r.contribution for r in rows) == pytest.approx(2 / 3 - 1 / 2, abs=1e-5)


def test_feature_view_versions_and_training_set(spark, tmp_path):
    subjects = generate_subjects(spark, 300)
    view = credit_bureau_features(subjects)
    root = str(tmp_path)
    view.register(root)
    stored = view.read(spark, root)
    assert len(stored.columns) == 35 and stored.count() == 300
    assert stored.schema["age"].metadata["comment"] == "Age in years"
    second = FeatureView("CREDIT_BUREAU_FEATURES", "subject_id", subjects.select("subject_id", "age"), "2")
    second.register(root)
    assert len(view.read(spark, root).columns) == 35 and len(second.read(spark, root).columns) == 2
    spine = subjects.select("subject_id", "default_flag").unionByName(
        spark.createDataFrame([("SUBJ999999999", 1)], "subject_id string, default_flag int")
    )
    assert training_set(spine, [view]).count() == 301
    for _ in range(2):
        assert dataset_snapshot(spine, [view], root).count() == 301


def test_mart_joins_only_what_is_asked_for(parts, mart):
    source = ApplicationMart(*parts)

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    assert joins(source.select("app_month", "decision")) == 0
    assert joins(source.select("island_group")) == 1
    assert joins(source.select("risk_segment", "default_flag", "lender_name")) == 3
    for name in MART_COLUMNS:
        pair = dict.fromkeys(["application_id", name])
        assert source.select(*pair).exceptAll(mart.select(*pair)).count() == 0, name
