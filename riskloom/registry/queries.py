"""Every operator as a named query over the staged credit tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as c
from riskloom.functions import fixed_values as fv
from riskloom.functions.filters import FilterSpec, last_days
from riskloom.functions.hashing import md5_uniform, md5_uniform_sql
from riskloom.functions.naming import clean_columns
from riskloom.operators import drift, encode, evaluate, ranks
from riskloom.operators.joins import attach_features, rows_with_keys
from riskloom.operators.upserts import BucketedTable
from riskloom.plans import features, mart, metrics, tiles, trends
from riskloom.session import scratch_path
from riskloom.sources import delimited, schemas, synthetic, tables
from riskloom.sources.testtables import SCORED_AT, CreditTables, credit_tables

AS_OF = dt.date(1998, 8, 2)
EVENTS_AS_OF = dt.date(2024, 1, 30)
BASELINE_END = dt.date(2024, 1, 11)
PRODUCT_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LOOKUP_COLUMNS = [
    "subject_id", "age", "region_code", "monthly_income", "credit_utilization", "max_dpd_12m"
]

Query = Callable[[CreditTables], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round floating results whose last bits depend on the order of summation."""
    return df.withColumns({n: F.round(n, d) for n, d in digits.items()})


def comparable(df: DataFrame) -> DataFrame:
    """Widen integers and turn decimals into doubles, so that any engine shows the same types."""

    def widen(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[widen(f) for f in df.schema.fields])


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from riskloom.registry import model_queries  # noqa: F401  registers the model and stream queries

    def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: comparable(query(credit_tables(spark, folder)))

    return {name: bound(query) for name, query in QUERIES.items()}


# --- scans, sources, sinks ------------------------------------------------------------------------


@register
def csv_ingest(t: CreditTables) -> DataFrame:
    names = ["event_id", "user_id", "event_type", "props"]
    path = scratch_path(t.spark, "events-csv")
    delimited.write_delimited(t.raw("events").select(*names), path)
    return delimited.read_text_fields(t.spark, path, names)


@register
def typed_load(t: CreditTables) -> DataFrame:
    path = scratch_path(t.spark, "applications-csv")
    delimited.write_delimited(t.applications, path)
    return delimited.read_delimited(t.spark, path, schemas.LOAN_APPLICATIONS)


@register
def append_load(t: CreditTables) -> DataFrame:
    file, table = scratch_path(t.spark, "lender-csv"), scratch_path(t.spark, "lender")
    delimited.write_delimited(t.lender, file)
    for _ in range(2):
        delimited.append_delimited(t.spark, file, schemas.DIM_LENDER, table)
    return tables.scan(t.spark, table)


@register
def ctas_overwrite(t: CreditTables) -> DataFrame:
    path = scratch_path(t.spark, "ctas")
    tables.replace_table(tiles.tile("monthly_volume", t.mart), path)
    return tables.replace_table(tiles.tile("monthly_by_decision", t.mart), path)


@register
def named_view(t: CreditTables) -> DataFrame:
    view = tables.named_view(t.mart.all_columns(), "mart_applications")
    return view.select("application_id", "island_group", "risk_segment", "score_band")


@register
def table_scan(t: CreditTables) -> DataFrame:
    return t.applications


@register
def row_count_validation(t: CreditTables) -> DataFrame:
    return tables.row_counts(
        {
            "DIM_REGION": t.region,
            "DIM_PRODUCT": t.product,
            "DIM_LENDER": t.lender,
            "LOAN_APPLICATIONS": t.applications,
            "MART_APPLICATIONS": t.mart.all_columns(),
            "MART_APP_MONTHLY": mart.mart_app_monthly(t.mart),
        }
    )


@register
def sample_exact_n(t: CreditTables) -> DataFrame:
    return ranks.smallest_hash_rows(
        t.applications.select("application_id", "decision"), "application_id", "sample", n=5000
    )


@register
def synthetic_features(t: CreditTables) -> DataFrame:
    df = t.wide
    return rounded(df, pd_true=9)


@register
def synthetic_applications(t: CreditTables) -> DataFrame:
    keys = t.raw("orders").select("o_orderkey")
    return synthetic.application_table(keys, "o_orderkey", 1_000_000, md5_uniform_sql)


@register
def feature_table_write(t: CreditTables) -> DataFrame:
    path = scratch_path(t.spark, "lookup")
    return tables.write_clustered(features.lookup_table(t.wide), path, "subject_id")


@register
def pk_check(t: CreditTables) -> DataFrame:
    """Order numbers are not a key of the lines: the violations."""
    return tables.key_violations(t.raw("lineitem"), "l_orderkey")


# --- projections ------------------------------------------------------------------------------------


@register
def select_core_features(t: CreditTables) -> DataFrame:
    return rounded(features.core_features(t.wide), dti_ratio=9)


@register
def select_exclude(t: CreditTables) -> DataFrame:
    return tables.exclude(t.subjects, "pd_true_prob", "default_flag")


@register
def lateral_alias(t: CreditTables) -> DataFrame:
    df = t.subjects.selectExpr(
        "subject_id",
        "monthly_installment / nullif(monthly_income, 0) AS installment_ratio",
        "least(coalesce(installment_ratio, 3e0), 3e0) AS capped_ratio",
    )
    return rounded(df, installment_ratio=6, capped_ratio=9)


@register
def dti_feature(t: CreditTables) -> DataFrame:
    return rounded(encode.with_dti(t.subjects).select("subject_id", "dti_ratio"), dti_ratio=6)


@register
def dti_nullable(t: CreditTables) -> DataFrame:
    ratio = c.dti_nullable(F.col("monthly_installment"), F.col("monthly_income"))
    return rounded(t.subjects.select("subject_id", ratio.alias("dti")), dti=6)


@register
def onehot_view(t: CreditTables) -> DataFrame:
    return rounded(encode.scoring_view(t.wide), dti_ratio=9)


@register
def credit_score(t: CreditTables) -> DataFrame:
    return t.subjects.select("subject_id", c.credit_score(F.col("pd_true_prob")).alias("credit_score"))


@register
def decision_band(t: CreditTables) -> DataFrame:
    return t.subjects.select("subject_id", c.decision_band(F.col("pd_true_prob")).alias("decision"))


@register
def score_band(t: CreditTables) -> DataFrame:
    return t.mart.select("application_id", "credit_score", "score_band")


@register
def risk_segment(t: CreditTables) -> DataFrame:
    return t.mart.select("application_id", "pd_probability", "risk_segment")


@register
def approved_flag(t: CreditTables) -> DataFrame:
    flag = c.approved_flag(F.col("decision")).alias("is_approved")
    return t.applications.select("application_id", "decision", flag)


@register
def calendar_cols(t: CreditTables) -> DataFrame:
    return t.mart.select("application_id", "app_date", "app_month", "app_week", "app_year")


@register
def age_band(t: CreditTables) -> DataFrame:
    return t.subjects.select("subject_id", "age", c.age_band(F.col("age")).alias("age_group"))


@register
def util_band(t: CreditTables) -> DataFrame:
    band = c.util_band(F.col("credit_utilization")).alias("util_band")
    return t.subjects.select("subject_id", "credit_utilization", band)


@register
def logit_pd(t: CreditTables) -> DataFrame:
    ratio = c.dti_nullable(F.col("monthly_installment"), F.col("monthly_income"))
    logit = c.latent_logit(ratio)
    df = t.wide.select(
        "subject_id", logit.alias("latent_logit"), c.probability(logit).alias("pd_true_prob")
    )
    return rounded(df, latent_logit=9, pd_true_prob=6)


@register
def bernoulli_label(t: CreditTables) -> DataFrame:
    draw = md5_uniform(F.col("subject_id"), "default")
    label = c.bernoulli_label(draw, F.col("pd_true_prob"))
    return t.subjects.select("subject_id", label.alias("label"))


@register
def uniform_draws(t: CreditTables) -> DataFrame:
    return t.wide.select("subject_id", *synthetic.CORE_DRAWS)


@register
def subject_key(t: CreditTables) -> DataFrame:
    key = c.padded_key("SUBJ", F.col("c_custkey"), 9).alias("subject_key")
    return t.raw("customer").select("c_custkey", key)


@register
def clean_column_names(t: CreditTables) -> DataFrame:
    awkward = ['"event_id"', "event__type ", "user id", "user-id", "value: {x}"]
    source = t.raw("events").select(
        "event_id", "event_type", "user_id", F.col("user_id").alias("again"), "value"
    )
    return clean_columns(source.toDF(*awkward))


@register
def split_by_dtype(t: CreditTables) -> DataFrame:
    categorical, numeric = encode.split_by_type(t.subjects, "subject_id", "default_flag")
    kinds = {n: "categorical" for n in categorical} | {n: "numeric" for n in numeric}
    counts = t.subjects.agg(*[F.count(n).alias(n) for n in kinds])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("kind"),
                             F.col(n).alias("n_values"))
                    for n, k in kinds.items()
                ]
            )
        )
    )


@register
def fillna_zero(t: CreditTables) -> DataFrame:
    return encode.fill_zero(
        t.applications.select(
            "application_id", F.col("tenor_months").cast("double").alias("tenor_months"), "lender_code"
        )
    )


@register
def add_scored_at(t: CreditTables) -> DataFrame:
    return t.subjects.select(
        "subject_id", c.stamp(SCORED_AT).alias("scored_at"), F.lit(mart.MODEL_VERSION).alias("model_version")
    )


# --- filters ------------------------------------------------------------------------------------------


@register
def lookup_one(t: CreditTables) -> DataFrame:
    return t.lookup.where(F.col("subject_id") == "SUBJ000000042").select(*LOOKUP_COLUMNS)


@register
def lookup_many(t: CreditTables) -> DataFrame:
    """The subjects that placed a request, by semi-join."""
    wanted = t.raw("events").select(c.padded_key("SUBJ", F.col("user_id"), 9).alias("subject_id"))
    return rows_with_keys(t.lookup, "subject_id", wanted, t.lookup_ranges).select(*LOOKUP_COLUMNS)


@register
def lookup_list(t: CreditTables) -> DataFrame:
    keys = ["SUBJ000000007", "SUBJ000000042", "SUBJ000000099", "SUBJ999999999"]
    return rows_with_keys(t.lookup, "subject_id", keys, t.lookup_ranges).select(*LOOKUP_COLUMNS)


@register
def count_by_secondary(t: CreditTables) -> DataFrame:
    return t.subjects_by_region.where(F.col("region_code") == "DKI").agg(F.count(F.lit(1)).alias("n_in_region"))


BUNDLE = FilterSpec(
    dt.date(1996, 1, 1),
    dt.date(1998, 12, 31),
    {
        "island_group": ["AFRICA", "ASIA", "EUROPE"],
        "product_class": ["Secured"],
        "channel": [],
        "risk_segment": ["Low", "Medium"],
    },
)


@register
def filter_bundle(t: CreditTables) -> DataFrame:
    return BUNDLE.apply(
        t.mart.select(
            "application_id", "app_date", "island_group", "product_class", "channel", "risk_segment"
        )
    )


@register
def filter_bundle_tile(t: CreditTables) -> DataFrame:
    return tiles.tile("lender_performance", t.mart, BUNDLE)


@register
def relative_date_filter(t: CreditTables) -> DataFrame:
    return t.applications.where(last_days("app_date", 30, AS_OF)).select("application_id", "app_date")


@register
def text_ilike(t: CreditTables) -> DataFrame:
    return trends.text_preview(t.raw("documents"), "text", "%the%and%").select("doc_id", "preview")


@register
def recent_intervals(t: CreditTables) -> DataFrame:
    as_of = F.lit("2024-01-30 23:58:00").cast("timestamp_ntz")
    log = t.raw("events").select("event_id", "ts", "event_type")
    return trends.recent(log, "ts", as_of, 2, "event_id", 10)


@register
def sidebar_filters(t: CreditTables) -> DataFrame:
    spec = FilterSpec(
        dt.date(1997, 1, 1), None,
        {"region_code": [1, 2, 3, 5, 8], "product_code": [], "channel": ["1-URGENT", "5-LOW"]},
    )
    chosen = spec.apply(t.applications)
    return chosen.groupBy("region_code").agg(F.count(F.lit(1)).alias("applications"))


@register
def picker_bounds(t: CreditTables) -> DataFrame:
    return trends.picker_bounds(t.applications)


@register
def filter_domain(t: CreditTables) -> DataFrame:
    return trends.domain(t.mart.select("island_group"), "island_group")


# --- joins ----------------------------------------------------------------------------------------------


@register
def mart_applications(t: CreditTables) -> DataFrame:
    return t.mart.all_columns()


@register
def training_set(t: CreditTables) -> DataFrame:
    spine = t.wide.select("subject_id", "default_flag")
    joined = features.training_set(spine, [features.credit_bureau_features(t.wide)])
    return rounded(joined, dti_ratio=9)


TEST_CATEGORIES = {
    "gender": fv.GENDERS,
    "employment_type": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "education": fv.EDUCATIONS,
}


def encoded_subjects(t: CreditTables) -> DataFrame:
    """Encoded features of the subjects that can be scored."""
    scorable = encode.with_dti(t.subjects.where(F.col("monthly_income") > 0))
    return scorable.select(
        "subject_id", *encode.dummies(TEST_CATEGORIES), "age", "monthly_income",
        "credit_utilization", "kol_status", "dti_ratio",
    )


@register
def encoded_lookup_join(t: CreditTables) -> DataFrame:
    requests = t.raw("events").select("event_id", F.col("user_id").alias("subject_id"))
    joined = attach_features(requests, encoded_subjects(t), "subject_id", "event_id", t.hot_users)
    return rounded(joined, dti_ratio=9)


def upsert_inputs(t: CreditTables) -> tuple[DataFrame, DataFrame]:
    base = t.subjects.where(F.col("monthly_income") > 0).select(
        "subject_id", "age", "credit_utilization", "num_inquiries_12m"
    )
    changes = t.raw("events").groupBy(F.col("user_id").alias("subject_id")).agg(
        F.round(F.max(F.when(F.col("event_type") == "purchase", F.col("value"))) / 1000, 3)
        .alias("credit_utilization"),
        F.count_if(F.col("event_type") == "signup").alias("num_inquiries_12m"),
    )
    return base, changes


@cache
def upsert_table(t: CreditTables) -> BucketedTable:
    """The stored features that the upsert changes, built once for a data folder."""
    return BucketedTable.create(upsert_inputs(t)[0], scratch_path(t.spark, "upsert"), "subject_id")


@register
def feature_upsert(t: CreditTables) -> DataFrame:
    _, changes = upsert_inputs(t)
    stored = upsert_table(t)
    return stored.read(stored.upsert(changes, increments=("num_inquiries_12m",), version=0))


# --- aggregates -------------------------------------------------------------------------------------------


@register
def feature_summary(t: CreditTables) -> DataFrame:
    return mart.feature_summary(t.subjects)


@register
def decision_summary(t: CreditTables) -> DataFrame:
    return mart.decision_summary(t.scores)


def _register_tile(name: str) -> None:
    QUERIES[name] = lambda t: tiles.tile(name, t.mart)
    if tiles.TILES[name].fits_monthly():
        QUERIES[f"{name}_monthly"] = lambda t: tiles.tile(name, t.mart, monthly=t.monthly)


for _name in tiles.TILES:
    _register_tile(_name)


@register
def monthly_approval_rate(t: CreditTables) -> DataFrame:
    return tiles.monthly_approval_rate(t.mart)


@register
def decision_mix_by_channel(t: CreditTables) -> DataFrame:
    return tiles.decision_mix_by_channel(t.mart)


@register
def monthly_decision_share(t: CreditTables) -> DataFrame:
    return tiles.monthly_decision_share(t.mart)


@register
def channel_share(t: CreditTables) -> DataFrame:
    return tiles.channel_share(t.mart)


@register
def decision_stage_counts(t: CreditTables) -> DataFrame:
    return tiles.decision_stage_counts(t.mart)


@register
def kpi_delta(t: CreditTables) -> DataFrame:
    return tiles.kpi_delta(
        t.mart,
        FilterSpec(dt.date(1998, 1, 1), dt.date(1998, 3, 31)),
        FilterSpec(dt.date(1997, 10, 1), dt.date(1997, 12, 31)),
    )


@register
def kpi_cards(t: CreditTables) -> DataFrame:
    return rounded(
        trends.kpi_cards(t.applications, t.subjects),
        approval_rate=9, avg_amount=4, default_rate=9, avg_income=4, avg_utilization=9,
    )


@register
def decision_funnel(t: CreditTables) -> DataFrame:
    return trends.decision_funnel(t.applications)


@register
def mart_app_monthly(t: CreditTables) -> DataFrame:
    return rounded(
        mart.mart_app_monthly(t.mart).drop("n_requested"),
        avg_requested=4, avg_pd=9, avg_credit_score=9, default_rate=9, sum_pd=6,
    )


@register
def monthly_trend_filled(t: CreditTables) -> DataFrame:
    return rounded(trends.period_trend(t.applications), avg_amount=4, approval_rate=9)


@register
def weekly_trend_filled(t: CreditTables) -> DataFrame:
    return rounded(trends.period_trend(t.applications, "week"), avg_amount=4, approval_rate=9)


@register
def crosstab_margins(t: CreditTables) -> DataFrame:
    return trends.crosstab(t.applications, "product_code", "decision", fv.DECISIONS)


@register
def crosstab_lender_channel_long(t: CreditTables) -> DataFrame:
    return trends.crosstab_long(t.applications, "lender_code", "channel")


@register
def crosstab_region_channel(t: CreditTables) -> DataFrame:
    return trends.crosstab(t.applications, "region_code", "channel")


@register
def crosstab_lender_product(t: CreditTables) -> DataFrame:
    return trends.crosstab(t.applications, "lender_code", "product_code")


@register
def heat_approval_region_product(t: CreditTables) -> DataFrame:
    df = trends.heat_approval_region_product(t.applications, PRODUCT_TYPES)
    return rounded(df, **{p: 9 for p in PRODUCT_TYPES})


@register
def default_rate_by_kol(t: CreditTables) -> DataFrame:
    return rounded(trends.default_rate_by_kol(t.subjects), default_rate=9)


@register
def pd_histogram(t: CreditTables) -> DataFrame:
    return trends.histogram(t.subjects, "pd_true_prob", "default_flag")


@register
def heat_age_util(t: CreditTables) -> DataFrame:
    return rounded(trends.heat_age_util(t.subjects), Low=9, Med=9, High=9, Over=9)


@register
def top_regions_amount(t: CreditTables) -> DataFrame:
    return rounded(trends.volume_and_amount(t.applications, "region_code", 10), avg_amount=4)


@register
def product_mix_amount(t: CreditTables) -> DataFrame:
    return trends.product_mix_amount(t.applications)


@register
def monthly_by_product(t: CreditTables) -> DataFrame:
    return trends.monthly_by_product(t.applications)


@register
def region_volume_avg_amount(t: CreditTables) -> DataFrame:
    return rounded(trends.volume_and_amount(t.applications, "region_code"), avg_amount=4)


@register
def util_income_scatter(t: CreditTables) -> DataFrame:
    return trends.util_income_scatter(t.subjects)


@register
def latency_percentiles(t: CreditTables) -> DataFrame:
    df = trends.latency_percentiles(t.raw("events"), "value", "ts")
    return rounded(df, mean_ms=6, per_second=9)


@register
def log_stats(t: CreditTables) -> DataFrame:
    log = t.raw("events").where((F.col("event_type") == "view") & F.col("props").ilike('%"K": 1%'))
    return rounded(trends.log_stats(log, "value", {"avg_user": "user_id"}), avg_ms=6, avg_user=6, median=6)


@register
def compare_two_logs(t: CreditTables) -> DataFrame:
    log = t.raw("events")
    clicks = log.where(F.col("event_type") == "click")
    purchases = log.where(F.col("event_type") == "purchase")
    df = trends.compare_logs(clicks, purchases, ("click", "purchase"), "value")
    return rounded(df, avg_ms=6, median=6)


@register
def preview_limit(t: CreditTables) -> DataFrame:
    return t.scores.select("subject_id", "pd_probability", "credit_score", "decision").orderBy(
        "subject_id"
    ).limit(1000)


# --- model data --------------------------------------------------------------------------------------------


@register
def onehot_fit_transform(t: CreditTables) -> DataFrame:
    categorical, _ = encode.split_by_type(t.subjects, "subject_id", "default_flag")
    learned = encode.learn_categories(t.subjects, categorical)
    return encode.onehot(t.subjects, learned)


SCALED = ["age", "monthly_income", "credit_utilization", "max_dpd_12m"]


@register
def standard_scale(t: CreditTables) -> DataFrame:
    train, test = ranks.hash_split(t.subjects, "subject_id", 0.75, "split")
    scaled = encode.standard_scale(
        test.select("subject_id", *SCALED), encode.scale_parameters(train, SCALED)
    )
    return rounded(scaled, **{n: 9 for n in SCALED})


@register
def random_split(t: CreditTables) -> DataFrame:
    train, test = ranks.hash_split(t.subjects.select("subject_id"), "subject_id", 0.75, "split")
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@register
def stratified_split(t: CreditTables) -> DataFrame:
    return ranks.smallest_hash_rows(
        t.subjects.select("subject_id", "default_flag"), "subject_id", "stratified",
        strata="default_flag", fraction=0.7,
    )


@register
def univariate_auc_rank(t: CreditTables) -> DataFrame:
    _, numeric = encode.split_by_type(t.wide, "subject_id", "default_flag")
    usable = [n for n in numeric if not n.startswith("pd_true")]
    return rounded(evaluate.univariate_rank(t.wide, usable, "default_flag"), strength=9)


@register
def auc_gini(t: CreditTables) -> DataFrame:
    df = evaluate.discrimination(t.subjects, "pd_true_prob", "default_flag")
    return rounded(df.drop("ks"), auc=9, gini=9)


@register
def ks_statistic(t: CreditTables) -> DataFrame:
    return rounded(
        evaluate.discrimination(t.subjects, "pd_true_prob", "default_flag").select("ks"), ks=9
    )


@register
def roc_curve(t: CreditTables) -> DataFrame:
    return rounded(evaluate.roc_curve(t.subjects, "pd_true_prob", "default_flag"), fpr=9, tpr=9)


def _classified(t: CreditTables) -> DataFrame:
    predicted = (F.col("pd_true_prob") >= fv.PD_REVIEW_BELOW).cast("int").alias("predicted")
    return t.subjects.select("default_flag", predicted)


@register
def confusion_matrix(t: CreditTables) -> DataFrame:
    return evaluate.confusion_matrix(_classified(t), "default_flag", "predicted")


@register
def classification_report(t: CreditTables) -> DataFrame:
    df = evaluate.classification_report(_classified(t), "default_flag", "predicted")
    return rounded(df, precision=9, recall=9, f1=9)


@register
def score_batch(t: CreditTables) -> DataFrame:
    ratio = c.dti_nullable(F.col("monthly_installment"), F.col("monthly_income"))
    pd = F.round(c.probability(c.latent_logit(ratio)), 6)
    return mart.score_results(t.wide, pd, scored_at=SCORED_AT)


# --- feature views, drift ------------------------------------------------------------------------------------


@register
def feature_view(t: CreditTables) -> DataFrame:
    root = scratch_path(t.spark, "feature-views")
    view = features.credit_bureau_features(t.wide)
    view.register(root)
    return rounded(view.read(t.spark, root).drop("version"), dti_ratio=9)


@register
def dataset_snapshot(t: CreditTables) -> DataFrame:
    root = scratch_path(t.spark, "datasets")
    spine = t.wide.select("subject_id", "default_flag")
    view = features.credit_bureau_features(t.wide)
    for _ in range(2):
        stored = features.dataset_snapshot(spine, [view], root)
    return rounded(stored, dti_ratio=9)


def monitor_sets(t: CreditTables) -> tuple[DataFrame, DataFrame]:
    """Baseline: the predictions of the first ten days; source: the later ones."""
    early = F.col("scored_at") < F.lit(BASELINE_END).cast("timestamp_ntz")
    return t.predictions.where(early), t.predictions.where(~early)


@register
def monitor_tables(t: CreditTables) -> DataFrame:
    """Both monitor tables as written, told apart by a name."""
    stored = [
        tables.replace_table(df, scratch_path(t.spark, f"monitor-{name}")).withColumn("part", F.lit(name))
        for name, df in zip(["baseline", "source"], monitor_sets(t))
    ]
    return stored[0].unionByName(stored[1])


@register
def drift_difference_of_means(t: CreditTables) -> DataFrame:
    baseline, source = monitor_sets(t)
    df = drift.difference_of_means(source, baseline, "scored_at", ["pd_true_prob"], EVENTS_AS_OF)
    return rounded(df, mean=9, baseline_mean=9, difference=9)


@register
def feature_drift(t: CreditTables) -> DataFrame:
    baseline, source = monitor_sets(t)
    df = drift.difference_of_means(
        source, baseline, "scored_at", ["value", "pd_true_prob", "default_flag"], EVENTS_AS_OF
    )
    return rounded(df, mean=6, baseline_mean=6, difference=6)


@register
def performance_by_window(t: CreditTables) -> DataFrame:
    df = drift.performance_by_day(
        t.predictions, "scored_at", "pd_true_prob", "default_flag", fv.PD_REVIEW_BELOW
    )
    return rounded(df, accuracy=9, auc=9)


# --- metrics and questions ---------------------------------------------------------------------------------------


@register
def metric_query(t: CreditTables) -> DataFrame:
    df = metrics.metric_query(
        t.applications, metrics.application_metrics(),
        ["total_applications", "approval_rate", "avg_loan_amount", "total_loan_amount", "avg_tenor"],
        ["channel", "decision"], "quarter",
    )
    return rounded(df, approval_rate=9, avg_loan_amount=4, avg_tenor=6)


@register
def metric_query_rollup(t: CreditTables) -> DataFrame:
    """The same question answered from the stored monthly sums."""
    df = metrics.metric_query(
        t.applications, metrics.application_metrics(),
        ["total_applications", "approval_rate", "avg_loan_amount", "total_loan_amount", "avg_tenor"],
        ["channel", "decision"], "quarter", rollup=t.metric_rollup,
    )
    return rounded(df, approval_rate=9, avg_loan_amount=4, avg_tenor=6)


@register
def metric_query_subjects(t: CreditTables) -> DataFrame:
    table = metrics.subject_metrics()
    df = metrics.metric_query(t.subjects, table, list(table.measures), ["gender", "education"])
    return rounded(
        df, default_rate=9, avg_pd=12, avg_income=4, avg_utilization=9, avg_dti=6, avg_dpd_12m=6,
        avg_num_loans=6,
    )


METRIC_DIGITS = {
    "approval_rate": 9, "avg_loan_amount": 4, "avg_tenor": 6, "default_rate": 9, "avg_pd": 12,
    "avg_income": 4, "avg_utilization": 9, "avg_dti": 6, "avg_dpd_12m": 6, "avg_num_loans": 6,
}


def _register_measure(name: str, table: Callable[[], metrics.MetricTable], source: str) -> None:
    def query(t: CreditTables) -> DataFrame:
        df = metrics.metric_query(getattr(t, source), table(), [name], ["region"])
        return rounded(df, **{name: METRIC_DIGITS[name]}) if name in METRIC_DIGITS else df

    QUERIES[f"m_{name}"] = query


for _name in ["total_applications", "approval_rate", "avg_loan_amount", "total_loan_amount", "avg_tenor"]:
    _register_measure(_name, metrics.application_metrics, "applications")
for _name in ["total_subjects", "default_rate", "avg_pd", "avg_income", "avg_utilization", "avg_dti",
              "avg_dpd_12m", "avg_num_loans"]:
    _register_measure(_name, metrics.subject_metrics, "subjects")


@register
def q_monthly_2025(t: CreditTables) -> DataFrame:
    """Monthly counts of one year; in the test tables 1997 stands in for 2025."""
    return metrics.monthly_in_year(t.applications, 1997)


@register
def q_default_by_kol(t: CreditTables) -> DataFrame:
    return rounded(metrics.default_by_kol(t.subjects), default_rate=9)


@register
def q_avg_amount_by_product(t: CreditTables) -> DataFrame:
    return rounded(metrics.avg_amount_by_product(t.applications), avg_loan_amount=4)


@register
def q_region_most_reject(t: CreditTables) -> DataFrame:
    return metrics.region_most_reject(t.applications)


@register
def q_approval_by_region(t: CreditTables) -> DataFrame:
    return rounded(metrics.approval_by_region(t.applications), approval_rate=9)


@register
def q_channel_trend(t: CreditTables) -> DataFrame:
    return metrics.channel_trend(t.applications)


@register
def q_last_month_total(t: CreditTables) -> DataFrame:
    return metrics.last_month_total(t.applications, AS_OF)


@register
def q_approval_product_channel(t: CreditTables) -> DataFrame:
    df = metrics.approval_product_channel(t.applications, PRIORITIES)
    return df.select("product_code", *[F.round(f"`{p}`", 9).alias(p) for p in PRIORITIES])


@register
def q_avg_pd_kol3(t: CreditTables) -> DataFrame:
    return rounded(metrics.avg_pd_of_kol(t.subjects, 3), avg_pd=12)


@register
def q_bnpl_vs_kta(t: CreditTables) -> DataFrame:
    """Two products side by side; the test products stand in for BNPL and KTA."""
    return metrics.products_side_by_side(t.applications, "PROMO", "ECONOMY")


@register
def q_income_by_default(t: CreditTables) -> DataFrame:
    return rounded(metrics.income_by_default(t.subjects), avg_income=4)


@register
def q_util_by_region(t: CreditTables) -> DataFrame:
    return rounded(metrics.utilization_by_region(t.subjects), avg_utilization=9)


@register
def q_default_by_age(t: CreditTables) -> DataFrame:
    return rounded(metrics.default_by_age(t.subjects), default_rate=9)


@register
def q_island_unsecured_default(t: CreditTables) -> DataFrame:
    return metrics.island_unsecured_default(t.mart)


@register
def q_reject_by_channel(t: CreditTables) -> DataFrame:
    return metrics.reject_by_channel(t.mart)


@register
def q_approval_change(t: CreditTables) -> DataFrame:
    return metrics.approval_change(t.mart, dt.date(1998, 1, 1), "product_class")
