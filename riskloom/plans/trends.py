"""Interactive-dashboard queries: cards, funnel, trends, cross-tabulations, risk and portfolio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskloom.functions import columns as c
from riskloom.functions.fixed_values import DECISIONS
from riskloom.operators.ranks import order_statistics
from riskloom.plans.tiles import with_share

def _approved() -> Column:
    return F.when(F.col("decision") == "APPROVE", 1.0).otherwise(0.0)


def _amount() -> Column:
    return F.col("requested_amount").cast("double")


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row results side by side: a union with NULLs, then the only non-NULL value each."""
    names = [n for part in parts for n in part.columns]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union.agg(*[F.max(n).alias(n) for n in names])


def kpi_cards(applications: DataFrame, subjects: DataFrame) -> DataFrame:
    """Three figures over the applications and three over the subjects."""
    left = applications.agg(
        F.count(F.lit(1)).alias("total_applications"),
        F.avg(_approved()).alias("approval_rate"),
        F.avg(_amount()).alias("avg_amount"),
    )
    right = subjects.agg(
        F.avg("default_flag").alias("default_rate"),
        F.avg("monthly_income").alias("avg_income"),
        F.avg("credit_utilization").alias("avg_utilization"),
    )
    return one_row(left, right)


def decision_funnel(applications: DataFrame) -> DataFrame:
    """Fixed stage order, 0 for a stage without applications, percent of the first stage."""
    counts = applications.agg(
        *[F.count_if(F.col("decision") == stage).alias(stage) for stage in DECISIONS]
    )
    stages = F.array(
        *[
            F.struct(F.lit(i + 1).alias("stage_order"), F.lit(s).alias("stage"), F.col(s).alias("applications"))
            for i, s in enumerate(DECISIONS)
        ]
    )
    first = F.nullif(F.col(DECISIONS[0]), F.lit(0))
    return counts.select(F.inline(stages), first.alias("_first")).select(
        "stage_order",
        "stage",
        "applications",
        F.round(100.0 * F.col("applications") / F.col("_first"), 4).alias("pct_of_first"),
    )


def period_trend(applications: DataFrame, grain: str = "month") -> DataFrame:
    """Volume, approvals, average amount and approval rate per period, empty periods included.

    Months are labelled by their first day, weeks by the Sunday that ends them. Each period also
    yields the empty periods up to the next one, so the facts are aggregated once; the window runs
    over one row per period.
    """
    day = F.col("app_date")
    if grain == "month":
        label, step = c.month_start(day), F.expr("interval 1 month")
    elif grain == "week":
        label, step = c.week_end(day), F.expr("interval 7 days")
    else:
        raise ValueError(f"unknown grain: {grain}")
    present = (
        applications.where(day.isNotNull())
        .groupBy(label.alias("period"))
        .agg(
            F.count("application_id").alias("total"),
            F.count_if(F.col("decision") == "APPROVE").alias("approved"),
            F.avg(_amount()).alias("avg_amount"),
        )
    )
    following = F.lead("period").over(W.orderBy("period"))
    until = F.coalesce(following, F.col("period") + step).cast("date")
    stretch = present.withColumn("until", until).select(
        "total", "approved", "avg_amount", "period", "until",
        F.posexplode(F.sequence("period", "until", step)).alias("pos", "day"),
    )
    empty = F.col("pos") > 0
    filled = stretch.where(F.col("day") < F.col("until")).select(
        F.col("day").alias("period"),
        F.when(empty, 0).otherwise(F.col("total")).alias("total"),
        F.when(empty, 0).otherwise(F.col("approved")).alias("approved"),
        F.when(~empty, F.col("avg_amount")).alias("avg_amount"),
    )
    return filled.withColumn("approval_rate", F.try_divide("approved", "total")).orderBy("period")


def domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct values that feed a filter."""
    return df.select(column).distinct().orderBy(column)


def known_values(df: DataFrame, column: str, max_values: int = 10_000) -> list:
    """Sorted non-NULL values of a low-cardinality column, for pivot headers; `crosstab_long` has no bound."""
    rows = domain(df.where(F.col(column).isNotNull()), column).limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{column} has more than {max_values} values")
    return [row[0] for row in rows]


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts by (row value, column value) with `All` margins, one line each, for domains of any size."""
    both = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    counts = both.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    margins = counts.cube(row, col).agg(
        F.sum("n").alias("n"), F.grouping(row).alias("_all_rows"), F.grouping(col).alias("_all_columns")
    )

    def label(column: str, margin: str) -> Column:
        return F.when(F.col(margin) == 1, "All").otherwise(F.col(column).cast("string")).alias(column)

    return margins.select(label(row, "_all_rows"), label(col, "_all_columns"), "n")


def crosstab(df: DataFrame, row: str, col: str, col_values: list | None = None) -> DataFrame:
    """Counts of row value by column value with an `All` row and an `All` column.

    Rows with a NULL in either column are left out. The facts are grouped once per row value; the
    margin is added over that small result.
    """
    values = known_values(df, col) if col_values is None else col_values
    both = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    counts = both.groupBy(F.col(row).cast("string").alias("_row")).agg(
        *[F.count_if(F.col(col) == v).alias(str(v)) for v in values],
        F.count(F.lit(1)).alias("All"),
    )
    names = [str(v) for v in values] + ["All"]
    margins = counts.rollup("_row").agg(
        *[F.sum(f"`{n}`").alias(n) for n in names], F.grouping("_row").alias("_margin")
    )
    label = F.when(F.col("_margin") == 1, "All").otherwise(F.col("_row")).alias(row)
    return margins.orderBy("_margin", "_row").select(label, *[F.col(f"`{n}`") for n in names])


def rate_matrix(
    df: DataFrame, row: Column, col: Column, flag: Column, col_values: list
) -> DataFrame:
    """Average of `flag` per row and column value; NULL where a combination does not occur."""
    return (
        df.where(row.isNotNull() & col.isNotNull())
        .groupBy(row)
        .agg(*[F.avg(F.when(col == v, flag)).alias(str(v)) for v in col_values])
        .orderBy(1)
    )


def heat_approval_region_product(applications: DataFrame, products: list) -> DataFrame:
    return rate_matrix(
        applications, F.col("region_code"), F.col("product_code"), _approved(), products
    )


def heat_age_util(subjects: DataFrame) -> DataFrame:
    age, util = c.age_band(F.col("age")), c.util_band(F.col("credit_utilization"))
    banded = subjects.select(age.alias("age_group"), util.alias("util_band"), "default_flag")
    return rate_matrix(
        banded, F.col("age_group"), F.col("util_band"), F.col("default_flag"),
        ["Low", "Med", "High", "Over"],
    )


def default_rate_by_kol(subjects: DataFrame) -> DataFrame:
    return (
        subjects.groupBy("kol_status")
        .agg(F.avg("default_flag").alias("default_rate"), F.count("subject_id").alias("n_subjects"))
        .orderBy("kol_status")
    )


def histogram(df: DataFrame, value: str, by: str, bins: int = 50) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value, and per `by`."""
    limits = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    low, high = limits.getField("low"), limits.getField("high")
    width = F.nullif((high - low) / bins, F.lit(0.0))
    position = F.floor((F.col(value) - low) / width)
    index = F.least(F.lit(bins - 1), F.coalesce(position, F.lit(0))).cast("bigint")
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(index.alias("bin"), by)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("bin", by)
    )


def volume_and_amount(applications: DataFrame, by: str, top: int | None = None) -> DataFrame:
    """Count and average amount per value, largest count first."""
    out = (
        applications.groupBy(by)
        .agg(F.count("application_id").alias("volume"), F.avg(_amount()).alias("avg_amount"))
        .orderBy(F.desc("volume"), by)
    )
    return out.limit(top) if top else out


def product_mix_amount(applications: DataFrame) -> DataFrame:
    sums = applications.groupBy("product_code").agg(
        F.sum("requested_amount").cast("double").alias("total_amount")
    )
    return with_share(sums, "total_amount").orderBy("product_code")


def monthly_by_product(applications: DataFrame) -> DataFrame:
    return (
        applications.groupBy(c.month_start(F.col("app_date")).alias("app_month"), "product_code")
        .agg(F.count(F.lit(1)).alias("applications"))
        .orderBy("app_month", "product_code")
    )


def util_income_scatter(subjects: DataFrame) -> DataFrame:
    """Every subject's point."""
    return subjects.select("subject_id", "credit_utilization", "monthly_income", "default_flag")


def picker_bounds(applications: DataFrame) -> DataFrame:
    return applications.agg(
        F.min("app_date").alias("first_day"), F.max("app_date").alias("last_day")
    )


def latency_percentiles(log: DataFrame, elapsed: str, at: str) -> DataFrame:
    """Count, mean, nearest-rank p50 / p95 / p99 and requests per second of a timing log."""
    seconds = F.unix_micros(F.max(at).cast("timestamp")) - F.unix_micros(F.min(at).cast("timestamp"))
    overall = log.agg(
        F.avg(elapsed).alias("mean_ms"),
        F.try_divide(F.count(elapsed) * F.lit(1e6), seconds).alias("per_second"),
    )
    ranked = order_statistics(log, elapsed, {"p50": 50, "p95": 95, "p99": 99})
    return one_row(overall, ranked.select("n", "p50", "p95", "p99"))


def log_stats(log: DataFrame, elapsed: str, measures: dict[str, str]) -> DataFrame:
    """Count, average and exact median of the elapsed time plus averages of further columns."""
    averages = log.agg(
        F.avg(elapsed).alias("avg_ms"), *[F.avg(col).alias(name) for name, col in measures.items()]
    )
    return one_row(averages, order_statistics(log, elapsed, {}).select("n", "median"))


def compare_logs(
    first: DataFrame, second: DataFrame, names: tuple[str, str], elapsed: str
) -> DataFrame:
    """Statistics of two timing logs side by side, one row per log."""
    both = first.select(F.lit(names[0]).alias("log"), elapsed).unionByName(
        second.select(F.lit(names[1]).alias("log"), elapsed)
    )
    averages = both.groupBy("log").agg(F.avg(elapsed).alias("avg_ms"))
    ranked = order_statistics(both, elapsed, {"p50": 50, "p95": 95}, ["log"])
    return averages.join(ranked, "log")


def text_preview(log: DataFrame, text: str, pattern: str, width: int = 60) -> DataFrame:
    """Rows whose text matches a case-insensitive pattern, with a preview of the text."""
    return log.where(F.col(text).ilike(pattern)).withColumn(
        "preview", F.left(F.col(text), F.lit(width))
    )


def recent(log: DataFrame, at: str, as_of: Column, hours: int, key: str, n: int) -> DataFrame:
    """The newest n rows of the last hours."""
    since = as_of - F.make_dt_interval(hours=F.lit(hours))
    return log.where((F.col(at) >= since) & (F.col(at) <= as_of)).orderBy(F.desc(at), key).limit(n)
