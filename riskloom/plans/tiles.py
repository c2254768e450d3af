"""Dashboard tiles: one grouped aggregate each over the application mart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from riskloom.functions.filters import FilterSpec
from riskloom.functions.fixed_values import APPROVAL_TARGET_PCT
from riskloom.plans.mart import MONTHLY_KEYS, ApplicationMart

Mart = ApplicationMart | DataFrame
#: Measures that sums and counts of the monthly pre-aggregate give.
MONTHLY_MEASURES = {
    "applications", "total_applications", "approval_rate_pct", "avg_credit_score", "avg_score",
    "default_rate_pct", "avg_pd",
}


def _percent(column: str, digits: int) -> Column:
    return F.round(100.0 * F.avg(column), digits)


def _measures() -> dict[str, tuple[str | None, Column]]:
    """Tile measures by name: the column they read and the aggregate."""
    return {
        "applications": (None, F.count(F.lit(1))),
        "total_applications": (None, F.count(F.lit(1))),
        "approval_rate_pct": ("is_approved", _percent("is_approved", 1)),
        "avg_credit_score": ("credit_score", F.round(F.avg("credit_score"))),
        "avg_score": ("credit_score", F.round(F.avg("credit_score"))),
        "default_rate_pct": ("default_flag", _percent("default_flag", 2)),
        "avg_pd": ("pd_probability", F.round(F.avg("pd_probability"), 4)),
    }


@dataclass(frozen=True)
class Tile:
    by: tuple[str, ...]
    measures: tuple[str, ...]
    descending: str | None = None
    limit: int | None = None

    def query(self, mart: Mart, filters: FilterSpec | None = None) -> DataFrame:
        """Filter, aggregate (map-side first), then order the chart-sized result.

        Only the columns the tile reads are asked of the mart, so that it can leave out joins.
        """
        known = _measures()
        read = [column for column, _ in (known[m] for m in self.measures) if column]
        filtered = filters.columns() if filters else []
        source = mart.select(*self.by, *[n for n in dict.fromkeys(read + filtered) if n not in self.by])
        if filters:
            source = filters.apply(source)
        out = source.groupBy(*self.by).agg(*[known[m][1].alias(m) for m in self.measures])
        order = [F.desc(self.descending)] if self.descending else []
        if self.by:
            out = out.orderBy(*order, *self.by)
        return out.limit(self.limit) if self.limit else out


    def fits_monthly(self, filters: FilterSpec | None = None) -> bool:
        """Whether the monthly pre-aggregate holds the tile's keys, measures and filters."""
        read = {*self.by, *(filters.columns() if filters else [])}
        return read <= set(MONTHLY_KEYS) and set(self.measures) <= MONTHLY_MEASURES

    def query_monthly(self, monthly: DataFrame, filters: FilterSpec | None = None) -> DataFrame:
        """The same rows from the stored pre-aggregate: sums of its sums and counts."""
        known = _monthly_measures()
        source = filters.apply(monthly) if filters else monthly
        out = source.groupBy(*self.by).agg(*[known[m].alias(m) for m in self.measures])
        order = [F.desc(self.descending)] if self.descending else []
        if self.by:
            out = out.orderBy(*order, *self.by)
        return out.limit(self.limit) if self.limit else out


def _monthly_measures() -> dict[str, Column]:
    """The measures over rows of the monthly pre-aggregate."""

    def mean(total: str, n: str) -> Column:
        return F.try_divide(F.sum(total).cast("double"), F.sum(n))

    count = F.coalesce(F.sum("n_applications"), F.lit(0))
    score = F.round(mean("sum_credit_score", "n_credit_score"))
    return {
        "applications": count,
        "total_applications": count,
        "approval_rate_pct": F.round(100.0 * mean("n_approved", "n_applications"), 1),
        "avg_credit_score": score,
        "avg_score": score,
        "default_rate_pct": F.round(100.0 * mean("n_default", "n_default_known"), 2),
        "avg_pd": F.round(mean("sum_pd", "n_pd"), 4),
    }


TILES = {
    "kpi_total_applications": Tile((), ("total_applications",)),
    "kpi_approval_rate": Tile((), ("approval_rate_pct",)),
    "kpi_avg_credit_score": Tile((), ("avg_credit_score",)),
    "kpi_default_rate": Tile((), ("default_rate_pct",)),
    "monthly_volume": Tile(("app_month",), ("applications",)),
    "monthly_by_decision": Tile(("app_month", "decision"), ("applications",)),
    "volume_by_island": Tile(("island_group",), ("applications",), "applications"),
    "product_class_by_decision": Tile(("product_class", "decision"), ("applications",)),
    "risk_mix": Tile(("risk_segment",), ("applications",)),
    "heat_default_island_class": Tile(("island_group", "product_class"), ("default_rate_pct",)),
    "heat_volume_band_channel": Tile(("score_band", "channel"), ("applications",)),
    "lender_performance": Tile(
        ("lender_name", "lender_type"),
        ("applications", "approval_rate_pct", "avg_pd", "avg_score", "default_rate_pct"),
        "applications",
    ),
    "region_risk_bubble": Tile(
        ("region_name", "island_group"), ("applications", "avg_pd", "approval_rate_pct")
    ),
    "monthly_by_island": Tile(("app_month", "island_group"), ("applications",)),
    "top10_regions": Tile(("region_name",), ("applications",), "applications", 10),
    "top5_lenders": Tile(("lender_name",), ("applications",), "applications", 5),
}


def tile(
    name: str, mart: Mart, filters: FilterSpec | None = None, monthly: DataFrame | None = None
) -> DataFrame:
    """A tile, from the monthly pre-aggregate if one is given that holds all it needs."""
    made = TILES[name]
    if monthly is not None and made.fits_monthly(filters):
        return made.query_monthly(monthly, filters)
    return made.query(mart, filters)


def with_share(counts: DataFrame, value: str, within: tuple[str, ...] = ()) -> DataFrame:
    """Percentage of `value` within a group of an already aggregated, chart-sized result."""
    total = F.sum(value).over(W.partitionBy(*within))
    return counts.withColumn("share_pct", F.round(100.0 * F.col(value) / F.nullif(total, F.lit(0)), 4))


def decision_mix_by_channel(mart: Mart, filters: FilterSpec | None = None) -> DataFrame:
    counts = Tile(("channel", "decision"), ("applications",)).query(mart, filters)
    return with_share(counts, "applications", ("channel",))


def monthly_decision_share(mart: Mart, filters: FilterSpec | None = None) -> DataFrame:
    return with_share(tile("monthly_by_decision", mart, filters), "applications", ("app_month",))


def channel_share(mart: Mart, filters: FilterSpec | None = None) -> DataFrame:
    counts = Tile(("channel",), ("applications",), "applications").query(mart, filters)
    return with_share(counts, "applications")


def monthly_approval_rate(mart: Mart, filters: FilterSpec | None = None) -> DataFrame:
    """Approval rate per month next to the constant target line."""
    rates = Tile(("app_month",), ("approval_rate_pct",)).query(mart, filters)
    return rates.withColumn("target_pct", F.lit(APPROVAL_TARGET_PCT))


def decision_stage_counts(mart: Mart, filters: FilterSpec | None = None) -> DataFrame:
    counts = Tile(("decision",), ("applications",)).query(mart, filters)
    return counts.withColumnRenamed("decision", "stage")


def kpi_delta(mart: Mart, current: FilterSpec, prior: FilterSpec) -> DataFrame:
    """The four scorecards for two periods and their differences, in one pass over both periods."""

    def values(suffix: str, inside: Column) -> list[Column]:
        def kept(name: str) -> Column:
            return F.when(inside, F.col(name))

        return [
            F.count_if(inside).alias(f"total_applications_{suffix}"),
            F.round(100.0 * F.avg(kept("is_approved")), 1).alias(f"approval_rate_pct_{suffix}"),
            F.round(F.avg(kept("credit_score"))).alias(f"avg_credit_score_{suffix}"),
            F.round(100.0 * F.avg(kept("default_flag")), 2).alias(f"default_rate_pct_{suffix}"),
        ]

    now, before = current.condition(), prior.condition()
    read = ["is_approved", "credit_score", "default_flag", *current.columns(), *prior.columns()]
    both = mart.select(*dict.fromkeys(read)).where(now | before).agg(*values("current", now), *values("prior", before))
    names = ["total_applications", "approval_rate_pct", "avg_credit_score", "default_rate_pct"]
    return both.select(
        "*",
        *[F.round(F.col(f"{n}_current") - F.col(f"{n}_prior"), 2).alias(f"{n}_delta") for n in names],
    )
