"""Score results, the application mart and its monthly pre-aggregate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import columns as c
from riskloom.operators.joins import (
    HotKeys,
    hot_keys,
    is_small,
    left_join_dimension,
    left_join_lookups,
)
from riskloom.sources.periods import PeriodStore

MODEL_VERSION = "V2_SPARK_ML"
MONTHLY_KEYS = [
    "app_month", "app_year", "region_name", "island_group", "product_name", "product_class",
    "lender_type", "channel", "decision", "risk_segment", "score_band",
]


def score_results(
    subjects: DataFrame,
    pd: Column,
    model_version: str = MODEL_VERSION,
    scored_at: str | None = None,
) -> DataFrame:
    """Probability, score and decision per subject, stamped with time and model version."""
    return (
        subjects.select("subject_id", pd.alias("pd_probability"))
        .withColumn("credit_score", c.credit_score(F.col("pd_probability")))
        .withColumn("decision", c.decision_band(F.col("pd_probability")))
        .withColumn("scored_at", c.stamp(scored_at))
        .withColumn("model_version", F.lit(model_version))
    )


# Columns of the mart in order, with the input columns each one is made of.
MART_INPUTS = {
    "application_id": ["application_id"],
    "subject_id": ["subject_id"],
    "app_date": ["app_date"],
    "app_month": ["app_date"],
    "app_week": ["app_date"],
    "app_year": ["app_date"],
    "channel": ["channel"],
    "requested_amount": ["requested_amount"],
    "tenor_months": ["tenor_months"],
    "decision": ["decision"],
    "is_approved": ["decision"],
    **{f"{d}_{part}": [f"{d}_{part}"] for d, part in [
        ("region", "code"), ("region", "name"), ("island", "group"),
        ("product", "code"), ("product", "name"), ("product", "class"),
        ("lender", "code"), ("lender", "name"), ("lender", "type"),
    ]},
    "pd_probability": ["pd_probability"],
    "credit_score": ["credit_score"],
    "score_band": ["credit_score"],
    "risk_segment": ["pd_probability"],
    "default_flag": ["default_flag"],
    "monthly_income": ["monthly_income"],
    "age": ["age"],
    "credit_utilization": ["credit_utilization"],
}
MART_COLUMNS = list(MART_INPUTS)


@dataclass
class ApplicationMart:
    """One row per application with its dimensions, score and subject columns.

    Codes come from the dimensions, so an unknown code is NULL; the decision is the application's.
    The dimension codes and subject ids are primary keys, so a lookup neither adds nor removes rows:
    `select` joins only the tables that the wanted columns come from. Scores and features share one
    shuffle of the applications, and subjects with very many applications are salted.
    """

    applications: DataFrame
    region: DataFrame
    product: DataFrame
    lender: DataFrame
    scores: DataFrame
    features: DataFrame
    hot: HotKeys | list | None = None
    _treatment: dict[str, tuple[bool, HotKeys | list]] = field(default_factory=dict, repr=False)

    def _how_to_join(self, code: str, dimension: DataFrame) -> tuple[bool, HotKeys | list]:
        """Whether a dimension is small, else its hot codes; found once, when it is first joined."""
        if code not in self._treatment:
            small = is_small(dimension)
            self._treatment[code] = (small, [] if small else hot_keys(self.applications, code))
        return self._treatment[code]

    def select(self, *names: str) -> DataFrame:
        wanted = list(dict.fromkeys(names))
        inputs = {source for name in wanted for source in MART_INPUTS[name]}
        facts = self.applications.withColumnsRenamed(
            {code: f"_{code}" for code in ("region_code", "product_code", "lender_code")}
        )
        for dimension, code in [
            (self.region, "region_code"),
            (self.product, "product_code"),
            (self.lender, "lender_code"),
        ]:
            used = [n for n in dimension.columns if n in inputs]
            if used:
                keyed = dimension.select(F.col(code).alias(f"_{code}"), *used)
                small, hot = self._how_to_join(code, dimension)
                facts = left_join_dimension(facts, keyed, f"_{code}", "application_id", small, hot)
        lookups = []
        for table, columns in [
            (self.scores, ["pd_probability", "credit_score"]),
            (self.features, ["default_flag", "monthly_income", "age", "credit_utilization"]),
        ]:
            used = [n for n in columns if n in inputs]
            if used:
                lookups.append(table.select("subject_id", *used))
        if lookups:
            if self.hot is None:
                self.hot = hot_keys(self.applications, "subject_id")
            facts = left_join_lookups(facts, lookups, "subject_id", "application_id", self.hot)
        day = F.col("app_date")
        derived = {
            "app_month": c.month_start(day),
            "app_week": c.week_start(day),
            "app_year": F.year(day),
            "is_approved": c.approved_flag(F.col("decision")),
            "score_band": c.score_band(F.col("credit_score")),
            "risk_segment": c.risk_segment(F.col("pd_probability")),
        }
        return facts.select(*[derived.get(n, F.col(n)).alias(n) for n in wanted])

    def all_columns(self) -> DataFrame:
        return self.select(*MART_COLUMNS)


def monthly_sums(mart: ApplicationMart | DataFrame, months: list | None = None) -> DataFrame:
    """Eleven keys with the sums and counts that add up over months and keys, of all months or of some."""
    names = [*MONTHLY_KEYS, "is_approved", "requested_amount", "pd_probability", "credit_score", "default_flag"]
    if months is None:
        rows = mart.select(*names)
    else:
        # The range of days reaches the scan of the facts, the months themselves are compared after it.
        rows = mart.select("app_date", *names)
        known = sorted(m for m in months if m is not None)
        inside = F.col("app_month").isin(known) if known else F.lit(False)
        if known:
            inside &= (F.col("app_date") >= F.lit(known[0])) & (F.col("app_date") < F.add_months(F.lit(known[-1]), 1))
        rows = rows.where((inside | F.col("app_month").isNull()) if None in months else inside)
    return rows.groupBy(*MONTHLY_KEYS).agg(
        F.count(F.lit(1)).alias("n_applications"),
        F.sum("is_approved").alias("n_approved"),
        F.sum("requested_amount").alias("total_requested"),
        F.count("requested_amount").alias("n_requested"),
        F.sum("pd_probability").alias("sum_pd"),
        F.count("pd_probability").alias("n_pd"),
        F.sum("credit_score").alias("sum_credit_score"),
        F.count("credit_score").alias("n_credit_score"),
        F.sum("default_flag").alias("n_default"),
        F.count("default_flag").alias("n_default_known"),
    )


def with_averages(sums: DataFrame) -> DataFrame:
    """The averages of the monthly pre-aggregate from its sums and counts."""

    def mean(total: str, n: str) -> Column:
        return F.try_divide(F.col(total).cast("double"), F.col(n))

    return sums.withColumns({
        "avg_requested": mean("total_requested", "n_requested"),
        "avg_pd": mean("sum_pd", "n_pd"),
        "avg_credit_score": mean("sum_credit_score", "n_credit_score"),
        "default_rate": mean("n_default", "n_default_known"),
    })


def mart_app_monthly(mart: ApplicationMart | DataFrame) -> DataFrame:
    """Eleven keys, seven measures, and the sums and counts needed to aggregate further."""
    return with_averages(monthly_sums(mart))


def store_monthly(mart: ApplicationMart | DataFrame, root: str) -> PeriodStore:
    """The sums and counts of the mart, in one folder for each month."""
    return PeriodStore.create(monthly_sums(mart), root, "app_month", MONTHLY_KEYS)


def feature_summary(subjects: DataFrame) -> DataFrame:
    return subjects.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg("default_flag"), 4).alias("default_rate"),
        F.round(F.avg("pd_true_prob"), 4).alias("avg_pd_true"),
    )


def decision_summary(scores: DataFrame) -> DataFrame:
    return (
        scores.groupBy("decision")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.round(F.avg("pd_probability"), 4).alias("avg_pd"),
        )
        .orderBy("avg_pd")
    )
