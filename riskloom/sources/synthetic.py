"""The wide synthetic subject table and the application log, generated by Spark."""

from __future__ import annotations

import datetime as dt
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import columns as c
from riskloom.functions import fixed_values as fv
from riskloom.functions.draws import Draw, Uniform
from riskloom.functions.hashing import fast_uniform_sql


def _integer(high: float, low: float = 0) -> Draw:
    return Draw("integer", low, high)


def _real(low: float, high: float, digits: int = 0, cap: float | None = None) -> Draw:
    return Draw("real", low, high, digits, cap)


def _skewed(high: float) -> Draw:
    """Floor of the product of a unit draw and U(0, high): small values are the common ones."""
    return Draw("product_integer", 0, high)


# Name and range of every column of the subject table.
CORE_DRAWS = {
    "age": _integer(65, 21),
    "gender": Draw("choice", options=("M", "F"), weights=(55, 45)),
    "monthly_income": _real(3e6, 60e6),
    "employment_type": Draw("choice", options=tuple(fv.EMPLOYMENT_TYPES)),
    "education": Draw("choice", options=tuple(fv.EDUCATIONS)),
    "region_code": Draw("choice", options=tuple(fv.REGION_CODES)),
    "dependents": _integer(3),
    "num_active_loans": _integer(8),
    "num_credit_cards": _integer(6),
    "num_fintech_loans": _integer(4),
    "num_bnpl_accounts": _integer(4),
    "num_lenders": _integer(12),
    "num_inquiries_3m": _integer(10),
    "num_inquiries_12m": _integer(18),
    "max_dpd_12m": _skewed(180),
    "max_dpd_24m": _skewed(120),
    "num_late_pmt_12m": _skewed(10),
    "oldest_acct_age_months": _integer(240, 6),
    "avg_acct_age_months": _integer(120, 3),
    "total_outstanding": _real(0, 500e6),
    "total_credit_limit": _real(5e6, 600e6),
    "credit_utilization": _real(0, 1.1, 3, cap=1.2),
    "monthly_installment": _real(0, 25e6),
    "kol_status": _integer(6, 1),
}
PER_PRODUCT = {
    "num_accounts": _integer(4),
    "outstanding": Draw("product_real", 1e6, 300e6),
    "limit": _real(1e6, 400e6),
    "util": _real(0, 1.1, 3, cap=1.2),
    "max_dpd": _skewed(120),
    "installment": _real(0, 15e6),
}
PER_WINDOW = [
    {"dpd_max": _skewed(180), "dpd_avg": _real(0, 60, 1), "cnt_late30": _skewed(8),
     "cnt_late60": _skewed(5), "cnt_late90": _skewed(4)},
    {"inq_bank": _integer(6), "inq_fintech": _integer(10), "inq_telco": _integer(4),
     "inq_total": _integer(18)},
    {"new_acct": _integer(5), "closed_acct": _integer(3)},
]
CHANGES = {
    "util_delta_3m": (-0.5, 0.5), "util_delta_6m": (-0.6, 0.6),
    "outstanding_delta_3m": (-50e6, 50e6), "outstanding_delta_6m": (-80e6, 80e6),
    "income_delta_6m": (-5e6, 5e6), "income_delta_12m": (-8e6, 8e6),
    "installment_delta_6m": (-3e6, 3e6), "limit_delta_12m": (-20e6, 60e6),
    "balance_growth_3m": (-0.4, 0.6), "balance_growth_6m": (-0.5, 0.8),
}
RATIOS = [
    "payment_ratio_3m", "payment_ratio_6m", "payment_ratio_12m", "revolving_ratio",
    "secured_ratio", "min_pay_ratio_6m", "overlimit_freq_12m", "cash_advance_ratio",
    "autopay_ratio", "ontime_ratio_12m",
]
LOAN_KINDS = ["cc", "kta", "kpr", "kkb", "bnpl", "fintech"]
WINDOWS = [3, 6, 12, 24]
NOISE = Draw("real", 0, 1, 4)


def bureau_draws(attributes: int = 60, components: int = 10) -> dict[str, Draw]:
    """The derived bureau columns, 170 by default."""
    draws = {f"{kind}_{name}": d for kind, (name, d) in product(LOAN_KINDS, PER_PRODUCT.items())}
    for family in PER_WINDOW:
        draws |= {f"{name}_{w}m": d for w, (name, d) in product(WINDOWS, family.items())}
    draws |= {name: _real(low, high, 3) for name, (low, high) in CHANGES.items()}
    draws |= {name: _real(0, 1, 3) for name in RATIOS}
    draws |= {f"bureau_score_comp_{i:02d}": _real(0, 100, 1) for i in range(1, components + 1)}
    draws |= {f"bureau_attr_{i:03d}": _real(0, 1, 4) for i in range(1, attributes + 1)}
    return draws


def subject_table(keys: DataFrame, key: str, uniform: Uniform = fast_uniform_sql) -> DataFrame:
    """Subject features for every key: a narrow job without a shuffle.

    Each value depends only on (key, column name), so any partitioning gives the same table. The few
    columns behind the default probability are drawn first; the wide row is built only once.
    """
    draws = CORE_DRAWS | bureau_draws()
    drivers = [n for n, *_ in fv.LOGIT_TERMS if n in draws] + ["monthly_installment"]
    first = keys.selectExpr(
        f"{key} AS _id",
        *[draws[n].sql(key, n, uniform) for n in drivers],
        NOISE.sql(key, "u_noise", uniform),
    )
    ratio = c.dti_nullable(F.col("monthly_installment"), F.col("monthly_income"))
    with_pd = (
        first.withColumn("pd_true", c.probability(c.latent_logit(ratio)))
        .withColumn("subject_id", c.padded_key("SUBJ", F.col("_id"), 9))
        .withColumn("default_flag", c.bernoulli_label(F.col("u_noise"), F.col("pd_true")))
    )
    return with_pd.selectExpr(
        "subject_id",
        *[n if n in drivers else d.sql("_id", n, uniform) for n, d in draws.items()],
        "pd_true",
        "round(pd_true, 6) AS pd_true_prob",
        "default_flag",
    )


def generate_subjects(spark: SparkSession, n: int = 1_000_000) -> DataFrame:
    return subject_table(spark.range(n), "id")


def application_table(
    keys: DataFrame,
    key: str,
    n_subjects: int,
    uniform: Uniform = fast_uniform_sql,
    first: dt.date = dt.date(2025, 1, 1),
    last: dt.date = dt.date(2026, 6, 30),
) -> DataFrame:
    """Loan applications for every key, with the domains and odds of the sample log."""

    def pick(name: str, options: list, weights: list | None = None) -> str:
        return Draw("choice", options=tuple(options), weights=tuple(weights or ())).sql(key, name, uniform)

    drawn = keys.selectExpr(
        f"{key} AS _id",
        pick("region_code", fv.REGION_CODES, fv.REGION_WEIGHTS),
        pick("product_code", fv.PRODUCT_CODES, fv.PRODUCT_WEIGHTS),
        pick("lender_code", fv.LENDER_CODES),
        pick("channel", fv.CHANNELS, fv.CHANNEL_WEIGHTS),
        pick("tenor", fv.TENORS),
        *[f"{uniform(key, n)} AS u_{n}" for n in ("subject", "day", "amount", "decision")],
    )
    base = F.element_at(
        F.create_map(*[F.lit(x) for pair in fv.PRODUCT_BASE_AMOUNT.items() for x in pair]),
        F.col("product_code"),
    )
    low, high = fv.AMOUNT_FACTORS
    amount = F.round(base * (low + round(high - low, 6) * F.col("u_amount")), -4)

    def shift(column: str, rule: tuple) -> Column:
        values, inside, outside = rule
        return F.when(F.col(column).isin(*values), inside).otherwise(outside)

    approve = (
        F.lit(fv.APPROVAL_ODDS)
        + shift("channel", fv.APPROVAL_BY_CHANNEL)
        + shift("product_code", fv.APPROVAL_BY_PRODUCT)
    )
    days = (last - first).days + 1
    return drawn.select(
        c.padded_key("APP", F.col("_id"), 8).alias("application_id"),
        c.padded_key("SUBJ", F.floor(F.col("u_subject") * n_subjects), 9).alias("subject_id"),
        F.date_add(F.lit(first), F.floor(F.col("u_day") * days).cast("int")).alias("app_date"),
        "region_code", "product_code", "lender_code", "channel",
        amount.cast("decimal(18,0)").alias("requested_amount"),
        F.col("tenor").cast("decimal(5,0)").alias("tenor_months"),
        F.when(F.col("u_decision") < approve, "APPROVE")
        .when(F.col("u_decision") < approve + fv.REVIEW_ODDS, "REVIEW")
        .otherwise("REJECT").alias("decision"),
    )
