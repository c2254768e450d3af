"""Declared business metrics and the questions asked of them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as c
from riskloom.functions.filters import FilterSpec, previous_month
from riskloom.plans.tiles import Mart
from riskloom.plans.trends import rate_matrix
from riskloom.session import materialize
from riskloom.sources.periods import PeriodStore


@dataclass(frozen=True)
class Measure:
    """A count, sum or average of `value`, which can also be had from stored sums and counts."""

    kind: str
    value: Column

    def direct(self) -> Column:
        return {"count": F.count, "sum": F.sum, "avg": F.avg}[self.kind](self.value)

    def parts(self, name: str) -> dict[str, Column]:
        """What has to be stored: columns that add up."""
        found = {} if self.kind == "count" else {f"{name}_sum": F.sum(self.value)}
        return found | ({} if self.kind == "sum" else {f"{name}_n": F.count(self.value)})

    def merged(self, name: str) -> Column:
        """The measure over stored parts."""
        total, n = F.sum(f"{name}_sum"), F.coalesce(F.sum(f"{name}_n"), F.lit(0))
        return {"count": n, "sum": total, "avg": F.try_divide(total.cast("double"), n)}[self.kind]


@dataclass(frozen=True)
class MetricTable:
    """Dimensions by name, the time dimension, and measures by name."""

    dimensions: dict[str, str]
    measures: dict[str, Measure]
    time: str | None = None


GRAINS = {"day": lambda d: d, "week": c.week_start, "month": c.month_start,
          "quarter": lambda d: F.trunc(d, "quarter"), "year": lambda d: F.trunc(d, "year")}


def application_metrics() -> MetricTable:
    approved = F.when(F.col("decision") == "APPROVE", 1.0).otherwise(0.0)
    return MetricTable(
        dimensions={
            "application_id": "application_id", "subject_id": "subject_id",
            "region": "region_code", "product": "product_code", "lender": "lender_code",
            "channel": "channel", "decision": "decision",
        },
        time="app_date",
        measures={
            "total_applications": Measure("count", F.col("application_id")),
            "approval_rate": Measure("avg", approved),
            "avg_loan_amount": Measure("avg", F.col("requested_amount").cast("double")),
            "total_loan_amount": Measure("sum", F.col("requested_amount")),
            "avg_tenor": Measure("avg", F.col("tenor_months").cast("double")),
        },
    )


def subject_metrics() -> MetricTable:
    dti = c.dti_nullable(F.col("monthly_installment"), F.col("monthly_income"))
    return MetricTable(
        dimensions={
            "subject_id": "subject_id", "gender": "gender", "employment_type": "employment_type",
            "education": "education", "region": "region_code", "kol_status": "kol_status",
            "default_flag": "default_flag",
        },
        measures={
            "total_subjects": Measure("count", F.col("subject_id")),
            "default_rate": Measure("avg", F.col("default_flag")),
            "avg_pd": Measure("avg", F.col("pd_true_prob")),
            "avg_income": Measure("avg", F.col("monthly_income")),
            "avg_utilization": Measure("avg", F.col("credit_utilization")),
            "avg_dti": Measure("avg", dti),
            "avg_dpd_12m": Measure("avg", F.col("max_dpd_12m")),
            "avg_num_loans": Measure("avg", F.col("num_active_loans")),
        },
    )


def _check(table: MetricTable, measures: list[str], dimensions: list[str], grain: str | None, filters: FilterSpec | None) -> None:
    unknown = [m for m in measures if m not in table.measures]
    unknown += [d for d in [*dimensions, *(filters.selections if filters else [])] if d not in table.dimensions]
    if unknown:
        raise ValueError(f"not declared: {unknown}")
    if (grain or (filters and (filters.start or filters.end))) and not table.time:
        raise ValueError("the table declares no time dimension")


def metric_query(
    df: DataFrame,
    table: MetricTable,
    measures: list[str],
    dimensions: list[str] = (),
    grain: str | None = None,
    where: Column | None = None,
    filters: FilterSpec | None = None,
    rollup: Rollup | None = None,
) -> DataFrame:
    """Measures by dimensions and, with a grain, by the start of the period: one aggregate.

    `filters` selects values of declared dimensions and a range of days; `where` is any other condition on
    the facts. A rollup that covers the question answers it instead of the facts.
    """
    _check(table, measures, dimensions, grain, filters)
    if rollup is not None and where is None and rollup.covers(measures, dimensions, grain, filters):
        return rollup.query(measures, dimensions, grain, filters)
    keys = [F.col(table.dimensions[d]).alias(d) for d in dimensions]
    if grain:
        keys.append(GRAINS[grain](F.col(table.time)).alias("period"))
    source = df if where is None else df.where(where)
    if filters:
        named = {table.dimensions[d]: values for d, values in filters.selections.items()}
        source = replace(filters, selections=named, date_column=table.time or filters.date_column).apply(source)
    return source.groupBy(*keys).agg(*[table.measures[m].direct().alias(m) for m in measures])


@dataclass(frozen=True)
class Rollup:
    """Sums and counts of a metric table by some of its dimensions and by month, stored month by month."""

    table: MetricTable
    dimensions: tuple[str, ...]
    store: PeriodStore

    @staticmethod
    def sums(df: DataFrame, table: MetricTable, dimensions: list[str]) -> DataFrame:
        parts = {name: part for m, measure in table.measures.items() for name, part in measure.parts(m).items()}
        keys = [F.col(table.dimensions[d]).alias(d) for d in dimensions]
        rows = df.groupBy(*keys, c.month_start(F.col(table.time)).alias("month"))
        return rows.agg(*[part.alias(name) for name, part in parts.items()])

    @staticmethod
    def build(df: DataFrame, table: MetricTable, dimensions: list[str], root: str) -> Rollup:
        made = Rollup.sums(df, table, dimensions)
        return Rollup(table, tuple(dimensions), PeriodStore.create(made, root, "month", [*dimensions, "month"]))

    def add(self, late: DataFrame) -> None:
        """Add facts that came later; only their months are written."""
        self.store.add(materialize(Rollup.sums(late, self.table, list(self.dimensions)), "late-sums"))

    def covers(self, measures: list[str], dimensions: list[str], grain: str | None, filters: FilterSpec | None) -> bool:
        """Whether the stored sums give the exact answer: all keys and filters are stored, and the periods and
        the range of days are made of whole months."""
        filters = filters or FilterSpec()
        read = {*dimensions, *(d for d, values in filters.selections.items() if values)}
        whole = filters.start is None or filters.start.day == 1
        whole &= filters.end is None or (filters.end + dt.timedelta(days=1)).day == 1
        return whole and read <= set(self.dimensions) and set(measures) <= set(self.table.measures) and grain in (None, "month", "quarter", "year")

    def query(self, measures: list[str], dimensions: list[str], grain: str | None, filters: FilterSpec | None) -> DataFrame:
        rows = self.store.read()
        if filters:
            rows = replace(filters, date_column="month").apply(rows)
        keys = [F.col(d) for d in dimensions]
        if grain:
            keys.append(GRAINS[grain](F.col("month")).alias("period"))
        return rows.groupBy(*keys).agg(*[self.table.measures[m].merged(m).alias(m) for m in measures])


def _applications(df: DataFrame, *args, **kwargs) -> DataFrame:
    return metric_query(df, application_metrics(), *args, **kwargs)


def _subjects(df: DataFrame, *args, **kwargs) -> DataFrame:
    return metric_query(df, subject_metrics(), *args, **kwargs)


def monthly_in_year(applications: DataFrame, year: int) -> DataFrame:
    inside = FilterSpec(dt.date(year, 1, 1), dt.date(year, 12, 31)).condition()
    return _applications(applications, ["total_applications"], grain="month", where=inside).orderBy(
        "period"
    )


def default_by_kol(subjects: DataFrame) -> DataFrame:
    return _subjects(subjects, ["default_rate"], ["kol_status"]).orderBy("kol_status")


def avg_amount_by_product(applications: DataFrame) -> DataFrame:
    return _applications(applications, ["avg_loan_amount"], ["product"]).orderBy("product")


def region_most_reject(applications: DataFrame) -> DataFrame:
    rejected = F.col("decision") == "REJECT"
    counts = _applications(applications, ["total_applications"], ["region"], where=rejected)
    return counts.orderBy(F.desc("total_applications"), "region").limit(1)


def approval_by_region(applications: DataFrame) -> DataFrame:
    return _applications(applications, ["approval_rate"], ["region"]).orderBy("region")


def channel_trend(applications: DataFrame) -> DataFrame:
    return _applications(applications, ["total_applications"], ["channel"], grain="month").orderBy(
        "period", "channel"
    )


def last_month_total(applications: DataFrame, as_of: dt.date) -> DataFrame:
    return _applications(
        applications, ["total_applications"], where=previous_month("app_date", as_of)
    )


def approval_product_channel(applications: DataFrame, channels: list) -> DataFrame:
    return rate_matrix(
        applications, F.col("product_code"), F.col("channel"),
        F.when(F.col("decision") == "APPROVE", 1.0).otherwise(0.0), channels,
    )


def avg_pd_of_kol(subjects: DataFrame, kol_status: int) -> DataFrame:
    return _subjects(subjects, ["avg_pd"], where=F.col("kol_status") == kol_status)


def products_side_by_side(applications: DataFrame, first: str, second: str) -> DataFrame:
    """Monthly counts of two products; months with neither do not appear."""
    product = F.col("product_code")
    return (
        applications.where(product.isin(first, second))
        .groupBy(c.month_start(F.col("app_date")).alias("period"))
        .agg(F.count_if(product == first).alias(first), F.count_if(product == second).alias(second))
        .orderBy("period")
    )


def income_by_default(subjects: DataFrame) -> DataFrame:
    return _subjects(subjects, ["avg_income"], ["default_flag"]).orderBy("default_flag")


def utilization_by_region(subjects: DataFrame) -> DataFrame:
    return _subjects(subjects, ["avg_utilization"], ["region"]).orderBy("region")


def default_by_age(subjects: DataFrame) -> DataFrame:
    banded = subjects.withColumn("age_group", c.age_band(F.col("age")))
    return banded.groupBy("age_group").agg(
        F.avg("default_flag").alias("default_rate"), F.count("subject_id").alias("n_subjects")
    )


def island_unsecured_default(mart: Mart) -> DataFrame:
    """Island group with the highest default rate among unsecured products."""
    rates = (
        mart.select("island_group", "product_class", "default_flag")
        .where(F.col("product_class") == "Unsecured")
        .groupBy("island_group")
        .agg(F.round(100.0 * F.avg("default_flag"), 4).alias("default_rate_pct"))
    )
    return rates.orderBy(F.desc("default_rate_pct"), "island_group").limit(1)


def reject_by_channel(mart: Mart) -> DataFrame:
    return (
        mart.select("channel", "decision")
        .where(F.col("decision") == "REJECT")
        .groupBy("channel")
        .agg(F.count(F.lit(1)).alias("applications"))
        .orderBy(F.desc("applications"), "channel")
    )


def approval_change(mart: Mart, quarter: dt.date, segment: str) -> DataFrame:
    """Approval rate of a quarter against the quarter before, split by segment.

    contribution = share-weighted approval now minus before; contributions add up to the total change.
    """
    start = F.trunc(F.lit(quarter), "quarter")
    now = (F.col("app_date") >= start) & (F.col("app_date") < F.add_months(start, 3))
    before = (F.col("app_date") >= F.add_months(start, -3)) & (F.col("app_date") < start)
    per_segment = (
        mart.select("app_date", "is_approved", segment)
        .where(now | before)
        .groupBy(segment)
        .agg(
            F.count_if(now).alias("n_now"),
            F.count_if(before).alias("n_before"),
            F.sum(F.when(now, F.col("is_approved")).otherwise(0)).alias("approved_now"),
            F.sum(F.when(before, F.col("is_approved")).otherwise(0)).alias("approved_before"),
        )
    )
    totals = per_segment.agg(
        F.struct(F.sum("n_now").alias("now"), F.sum("n_before").alias("before"))
    ).scalar()
    return per_segment.select(
        segment,
        "n_now",
        "n_before",
        F.round(F.try_divide("approved_now", "n_now"), 6).alias("rate_now"),
        F.round(F.try_divide("approved_before", "n_before"), 6).alias("rate_before"),
        F.round(
            F.coalesce(F.try_divide(F.col("approved_now"), totals.getField("now")), F.lit(0.0))
            - F.coalesce(F.try_divide(F.col("approved_before"), totals.getField("before")), F.lit(0.0)),
            6,
        ).alias("contribution"),
    )
