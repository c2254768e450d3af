import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.functions import columns as c
from riskloom.functions.draws import Draw
from riskloom.functions.filters import FilterSpec, last_days, previous_month
from riskloom.functions.hashing import fast_uniform_sql, md5_uniform, md5_uniform_sql
from riskloom.functions.naming import clean_names


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_decision_and_segment_cut_offs_are_strict(rows):
    df = rows("pd double", (0.0999999,), (0.10,), (0.2999999,), (0.30,), (None,))
    assert values(df, c.decision_band(F.col("pd"))) == ["APPROVE", "REVIEW", "REVIEW", "REJECT", "REJECT"]
    assert values(df, c.risk_segment(F.col("pd"))) == ["Low", "Medium", "Medium", "High", "High"]


def test_score_bands_at_their_bounds_and_without_score(rows):
    df = rows("s double", (579.0,), (580.0,), (670.0,), (740.0,), (800.0,), (None,))
    assert values(df, c.score_band(F.col("s"))) == [
        "1_Poor", "2_Fair", "3_Good", "4_VeryGood", "5_Excellent", "5_Excellent"
    ]


def test_score_rounds_halves_away_from_zero(rows):
    df = rows("pd double", (0.0,), (1.0,), (0.05,), (0.11,), (0.75,))
    assert values(df, c.credit_score(F.col("pd"))) == [850.0, 300.0, 823.0, 790.0, 438.0]
    even = values(df, c.credit_score(F.col("pd"), half_even=True))
    assert even == [850.0, 300.0, 822.0, 790.0, 438.0]


def test_both_debt_to_income_definitions(rows):
    df = rows("i double, m double", (10.0, 0.0), (10.0, 5.0), (None, 5.0))
    assert values(df, c.dti_ratio(F.col("i"), F.col("m"))) == [10.0, 2.0, None]
    assert values(df, c.dti_nullable(F.col("i"), F.col("m"))) == [None, 2.0, None]


def test_bands_are_right_closed(rows):
    df = rows("u double, a int", (0.0, 20), (0.3, 21), (0.31, 30), (1.2, 31), (1.3, 70), (None, 71))
    assert values(df, c.util_band(F.col("u"))) == [None, "Low", "Med", "Over", None, None]
    assert values(df, c.age_band(F.col("a"))) == [None, "21-30", "21-30", "31-40", "61+", None]


def test_week_labels(rows):
    days = [dt.date(2025, 1, 6) + dt.timedelta(days=i) for i in range(7)]
    df = rows("d date", *[(d,) for d in days])
    assert set(values(df, c.week_start(F.col("d")))) == {dt.date(2025, 1, 6)}
    assert set(values(df, c.week_end(F.col("d")))) == {dt.date(2025, 1, 12)}


def test_missing_decision_and_probability_give_zero(rows):
    df = rows("d string, p double", ("APPROVE", 0.9), ("REVIEW", 0.1), (None, None))
    assert values(df, c.approved_flag(F.col("d"))) == [1, 0, 0]
    assert values(df, c.bernoulli_label(F.lit(0.5), F.col("p"))) == [1, 0, 0]


def test_wide_keys_are_not_cut(rows):
    df = rows("n bigint", (7,), (123456789,), (12345678901,))
    assert values(df, c.padded_key("SUBJ", F.col("n"), 9)) == [
        "SUBJ000000007", "SUBJ123456789", "SUBJ12345678901"
    ]


def test_stamps_carry_no_zone(spark):
    df = spark.range(1).select(c.stamp("2026-07-01 00:00:00").alias("a"), c.stamp().alias("b"))
    assert [t for _, t in df.dtypes] == ["timestamp_ntz", "timestamp_ntz"]


def test_clean_names():
    raw = ['"GENDER_F"', "a, b", "A  B", "x__y_", "a-b", 'Mobile "App"']
    assert clean_names(raw) == ["GENDER_F", "A_B", "A_B_1", "X_Y", "A_B_2", "MOBILE_APP"]
    assert clean_names(["a", "a", "a_1", "a", "__", ""]) == ["A", "A_1", "A_1_1", "A_2", "COLUMN", "COLUMN_1"]
    assert clean_names(["a_1", "a", "a"]) == ["A_1", "A", "A_2"]


@pytest.mark.parametrize("uniform", [fast_uniform_sql, md5_uniform_sql])
def test_draws_keep_their_ranges(spark, uniform):
    keys = spark.range(20000)
    df = keys.selectExpr(
        Draw("integer", 1, 6).sql("id", "kol", uniform),
        Draw("real", -0.5, 0.8, 3).sql("id", "growth", uniform),
        Draw("real", 0, 1.5, 3, cap=1.2).sql("id", "util", uniform),
        Draw("product_integer", 0, 180).sql("id", "dpd", uniform),
        Draw("choice", options=("a", "b"), weights=(3, 1)).sql("id", "w", uniform),
    )
    r = df.agg(
        F.min("kol"), F.max("kol"), F.min("growth"), F.max("growth"), F.max("util"), F.avg("dpd"),
        F.avg((F.col("w") == "a").cast("int")),
    ).first()
    assert (r[0], r[1]) == (1, 5)
    assert -0.5 <= r[2] < -0.49 and 0.79 < r[3] <= 0.8 and r[4] == 1.2
    assert abs(r[5] - 44.5) < 1.5 and abs(r[6] - 0.75) < 0.01


def test_empty_filters_restrict_nothing(rows):
    df = rows("app_date date, channel string", (dt.date(2025, 1, 1), "Web"), (None, None))
    assert FilterSpec().apply(df).count() == 2
    assert FilterSpec(selections={"channel": []}).apply(df).count() == 2
    assert FilterSpec(selections={"channel": ["x' OR 1=1"]}).apply(df).count() == 0
    assert FilterSpec(start=dt.date(2025, 1, 1), end=dt.date(2025, 1, 1)).apply(df).count() == 1


def test_relative_periods(rows):
    days = [dt.date(2025, 2, 28), dt.date(2025, 3, 1), dt.date(2025, 3, 31), dt.date(2025, 4, 1)]
    df = rows("d date", *[(d,) for d in days])
    assert df.where(previous_month("d", dt.date(2025, 4, 15))).count() == 2
    assert df.where(last_days("d", 1, dt.date(2025, 4, 1))).count() == 1


def test_both_forms_of_the_md5_draw_agree(spark):
    df = spark.range(500).select(
        md5_uniform(F.col("id"), "x").alias("a"), F.expr(md5_uniform_sql("id", "x")).alias("b")
    )
    assert df.where("a != b or a < 0 or a >= 1").count() == 0


def test_salts_of_the_subject_table_differ():
    from zlib import crc32

    from riskloom.sources.synthetic import CORE_DRAWS, bureau_draws

    names = [n + s for n in CORE_DRAWS | bureau_draws() for s in ("", "/2")] + ["u_noise"]
    assert len({crc32(n.encode()) for n in names}) == len(names)
