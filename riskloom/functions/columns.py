"""Derived credit-risk columns as plain Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions import fixed_values as fv


def dti_ratio(installment: Column, income: Column) -> Column:
    """Debt-to-income feature: an income of zero divides by one."""
    return installment / F.when(income == 0, F.lit(1.0)).otherwise(income)


def dti_nullable(installment: Column, income: Column) -> Column:
    """Debt-to-income measure: an income of zero gives NULL."""
    return installment / F.nullif(income, F.lit(0.0))


def credit_score(pd: Column, half_even: bool = False) -> Column:
    """Score 300..850; halves round away from zero, or to the even neighbour as in request scripts."""
    points = 550 * (1 - pd)
    return 300 + (F.bround(points) if half_even else F.round(points))


def decision_band(pd: Column) -> Column:
    return (
        F.when(pd < fv.PD_APPROVE_BELOW, "APPROVE")
        .when(pd < fv.PD_REVIEW_BELOW, "REVIEW")
        .otherwise("REJECT")
    )


def score_band(score: Column) -> Column:
    """Five bands with strict upper bounds; a missing score falls into the last one."""
    band = F
    for cut, label in zip(fv.SCORE_CUTS, fv.SCORE_BANDS):
        band = band.when(score < cut, label)
    return band.otherwise(fv.SCORE_BANDS[-1])


def risk_segment(pd: Column) -> Column:
    """Low / Medium / High; a missing probability is High."""
    return (
        F.when(pd < fv.PD_APPROVE_BELOW, "Low")
        .when(pd < fv.PD_REVIEW_BELOW, "Medium")
        .otherwise("High")
    )


def approved_flag(decision: Column) -> Column:
    return F.when(decision == "APPROVE", 1).otherwise(0)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_start(day: Column) -> Column:
    """Monday on or before `day`."""
    return F.trunc(day, "week")


def week_end(day: Column) -> Column:
    """Sunday on or after `day`."""
    return F.date_add(F.trunc(day, "week"), 6)


def right_closed_band(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the interval (edges[i], edges[i+1]] holding `value`, NULL outside all of them."""
    band = F
    for low, high, label in zip(edges, edges[1:], labels):
        band = band.when((value > low) & (value <= high), label)
    return band


def age_band(age: Column) -> Column:
    return right_closed_band(
        age, [20, 30, 40, 50, 60, 70], ["21-30", "31-40", "41-50", "51-60", "61+"]
    )


def util_band(utilization: Column) -> Column:
    return right_closed_band(utilization, [0.0, 0.3, 0.6, 0.9, 1.2], ["Low", "Med", "High", "Over"])


def latent_logit(installment_ratio: Column) -> Column:
    """Linear credit-risk score over the core columns; NULL if any input is NULL."""
    terms = []
    for name, centre, scale, weight in fv.LOGIT_TERMS:
        value = installment_ratio if name == "installment_ratio" else F.col(name)
        centred = value - F.lit(centre)
        terms.append(F.lit(weight) * (centred if scale == 1.0 else centred / F.lit(scale)))
    return reduce(add, terms, F.lit(fv.LOGIT_INTERCEPT))


def probability(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def bernoulli_label(uniform: Column, probability_: Column) -> Column:
    """1 where the draw falls below the probability; a missing probability gives 0."""
    return F.when(uniform < probability_, 1).otherwise(0)


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """Text key such as SUBJ000000042; a number wider than `width` is kept whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0"))


def stamp(text: str | None = None) -> Column:
    """A zone-less timestamp: the given literal, or the current time."""
    source = F.current_timestamp() if text is None else F.lit(text)
    return source.cast("timestamp_ntz")
