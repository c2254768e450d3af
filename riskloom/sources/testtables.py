"""The credit tables expressed over the shared star-schema test tables.

Customers act as subjects, orders as loan applications, part types as products, suppliers as
lenders, nations as regions and events as request, prediction and timing logs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import columns as c
from riskloom.functions import fixed_values as fv
from riskloom.functions.hashing import md5_uniform, md5_uniform_sql
from riskloom.operators.joins import (
    HotKeys,
    attach_features,
    hot_keys,
    is_small,
    left_join_dimension,
    left_join_lookups,
)
from riskloom.plans.features import lookup_table
from riskloom.plans.mart import ApplicationMart, score_results, store_monthly, with_averages
from riskloom.plans.metrics import Rollup, application_metrics
from riskloom.session import materialize, scratch_path
from riskloom.sources.periods import PeriodStore
from riskloom.sources.synthetic import subject_table
from riskloom.sources.tables import KeyRanges, replace_table, write_clustered

SCORED_AT = "2024-01-31 00:00:00"
#: Wide rows that one task makes.
ROWS_PER_TASK = 200_000


class CreditTables:
    """Staged tables of one data folder.

    Fact-like tables are written once to the scratch area, as the load step of the warehouse would
    do, and every query reads the written tables.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def region(self) -> DataFrame:
        joined = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return materialize(
            joined.select(
                F.col("n_nationkey").alias("region_code"),
                F.col("n_name").alias("region_name"),
                F.col("r_name").alias("island_group"),
            ),
            "dim-region",
        )

    @cached_property
    def product(self) -> DataFrame:
        secured = F.col("p_type").isin("LARGE", "MEDIUM", "STANDARD")
        return materialize(
            self.raw("part").select("p_type").distinct().select(
                F.col("p_type").alias("product_code"),
                F.col("p_type").alias("product_name"),
                F.when(secured, "Secured").otherwise("Unsecured").alias("product_class"),
            ),
            "dim-product",
        )

    @cached_property
    def lender(self) -> DataFrame:
        kinds = F.array(F.lit("Bank"), F.lit("Fintech"), F.lit("Multifinance"))
        return materialize(
            self.raw("supplier").select(
                F.col("s_suppkey").alias("lender_code"),
                F.col("s_name").alias("lender_name"),
                F.element_at(kinds, (F.col("s_suppkey") % 3 + 1).cast("int")).alias("lender_type"),
            ),
            "dim-lender",
        )

    @cached_property
    def _order_lines(self) -> DataFrame:
        """Lines per order: the largest table is read and combined once, before any join."""
        combined = self.raw("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("l_partkey"),
            F.min("l_suppkey").alias("l_suppkey"),
            F.max("l_quantity").alias("quantity"),
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        )
        return materialize(combined.withColumnRenamed("l_orderkey", "o_orderkey"), "order-lines")

    @cached_property
    def applications(self) -> DataFrame:
        status = F.col("o_orderstatus")
        customers = self.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        parts = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        orders = self.raw("orders")
        placed = attach_features(
            orders, customers, "o_custkey", "o_orderkey", hot_keys(orders, "o_custkey")
        )
        lines = self._order_lines.select("o_orderkey", "l_partkey", "l_suppkey", "quantity")
        ordered = placed.join(lines, "o_orderkey", "left")
        small = is_small(parts)
        hot_parts = [] if small else hot_keys(lines, "l_partkey")
        joined = left_join_dimension(ordered, parts, "l_partkey", "o_orderkey", small, hot_parts)
        return materialize(
            joined.select(
                c.padded_key("APP", F.col("o_orderkey"), 8).alias("application_id"),
                F.col("o_custkey").alias("subject_id"),
                F.col("o_orderdate").cast("date").alias("app_date"),
                F.col("c_nationkey").alias("region_code"),
                F.col("p_type").alias("product_code"),
                F.col("l_suppkey").alias("lender_code"),
                F.col("o_orderpriority").alias("channel"),
                F.round("o_totalprice").cast("decimal(18,0)").alias("requested_amount"),
                F.col("quantity").cast("decimal(5,0)").alias("tenor_months"),
                F.when(status == "F", "APPROVE").when(status == "P", "REVIEW")
                .otherwise("REJECT").alias("decision"),
            ).sortWithinPartitions("app_date"),
            "loan-applications",
        )

    @cached_property
    def subjects(self) -> DataFrame:
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")
        lines = self._order_lines.select("o_orderkey", "n_lines", "n_returned")
        per_customer = (
            orders.join(lines, "o_orderkey", "left")
            .groupBy("o_custkey")
            .agg(
                F.count(F.lit(1)).alias("n_orders"),
                F.max("o_totalprice").alias("largest"),
                F.sum("n_lines").alias("n_lines"),
                F.sum("n_returned").alias("n_returned"),
            )
        )
        per_user = self.raw("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
        key = F.col("c_custkey")
        returned = F.coalesce("n_returned", F.lit(0))
        core = (
            self.raw("customer")
            .join(per_customer, key == F.col("o_custkey"), "left")
            .join(per_user, key == F.col("user_id"), "left")
            .select(
                key.alias("subject_id"),
                _int(21 + key % 44).alias("age"),
                F.when(key % 9 < 5, "M").otherwise("F").alias("gender"),
                F.col("c_mktsegment").alias("employment_type"),
                F.element_at(
                    F.array(*[F.lit(e) for e in ("SMA", "D3", "S1", "S2", "SD")]), _int(key % 5 + 1)
                ).alias("education"),
                F.col("c_nationkey").alias("region_code"),
                F.greatest(F.round(F.col("c_acctbal") * 6000), F.lit(0.0)).alias("monthly_income"),
                F.round(F.col("largest") * 20).alias("monthly_installment"),
                F.round(F.least(F.lit(1.2), F.col("n_orders") * F.lit(0.055)), 3)
                .alias("credit_utilization"),
                _int(F.least(F.lit(180), 3 * returned)).alias("max_dpd_12m"),
                _int(F.least(F.lit(120), F.coalesce("n_lines", F.lit(0)))).alias("max_dpd_24m"),
                _int(
                    F.when(F.col("n_events").isNull(), key % 18)
                    .otherwise(F.least(F.lit(17), F.col("n_events")))
                ).alias("num_inquiries_12m"),
                _int(key % 4).alias("num_fintech_loans"),
                _int(key % 3).alias("num_bnpl_accounts"),
                _int(key % 8).alias("num_active_loans"),
                _int(1 + key % 5).alias("kol_status"),
                _int(returned % 10).alias("num_late_pmt_12m"),
                _int(3 + key % 117).alias("avg_acct_age_months"),
            )
        )
        income = F.col("monthly_income")
        ratio = c.dti_nullable(F.col("monthly_installment"), income)
        capped = F.least(F.coalesce(ratio, F.lit(3.0)), F.lit(3.0))
        pd = c.probability(F.col("latent_logit"))
        draw = md5_uniform(F.col("subject_id"), "default")
        labelled = core.withColumn("latent_logit", c.latent_logit(capped)).select(
            *core.columns,
            F.round(pd, 6).alias("pd_true_prob"),
            c.bernoulli_label(draw, pd).alias("default_flag"),
        )
        return materialize(labelled, "subject-features")

    @cached_property
    def scores(self) -> DataFrame:
        """Scores of the subjects with a verified income; the others stay unscored."""
        scorable = self.subjects.where(F.col("monthly_income") > 0)
        return materialize(
            score_results(scorable, F.col("pd_true_prob"), scored_at=SCORED_AT), "score-results"
        )

    @cached_property
    def wide(self) -> DataFrame:
        """The 198-column feature table, one row per customer, with reproducible draws."""
        return materialize(self._drawn, "subject-features-wide")

    @property
    def _drawn(self) -> DataFrame:
        keys = self.raw("customer").select(F.col("c_custkey").alias("rn"))
        # A few ids cost much computing: spread them over all cores, and many over as many tasks as they fill.
        tasks = max(self.spark.sparkContext.defaultParallelism, keys.count() // ROWS_PER_TASK)
        spread = keys.repartition(tasks, "rn")
        return subject_table(spread, "rn", md5_uniform_sql)

    def _wide_part(self, columns: list[str], label: str) -> DataFrame:
        """Columns of the wide table: read from it once it is stored, else drawn and stored without the others.

        A draw depends only on key and column name, and costs more than all else in the table.
        """
        if "wide" in self.__dict__:
            return self.wide.select(*columns)
        return materialize(self._drawn.select(*columns), label)

    @cached_property
    def model_inputs(self) -> DataFrame:
        """The columns of the wide table that models are fitted on and score, with label and true probability."""
        inputs = [*fv.SCORING_CATEGORIES, *fv.SCORING_NUMERICS, "monthly_installment", "monthly_income"]
        return self._wide_part([*dict.fromkeys(["subject_id", *inputs, "default_flag", "pd_true"])], "model-inputs")

    @cached_property
    def lookup(self) -> DataFrame:
        """The columns served to requests, sorted by subject: a key lookup skips all row groups but a few."""
        served = lookup_table(self._wide_part(["subject_id", *fv.LOOKUP_FEATURES], "lookup-inputs"))
        return write_clustered(served, scratch_path(self.spark, "lookup"), "subject_id")

    @cached_property
    def lookup_ranges(self) -> KeyRanges:
        return KeyRanges.of(self.lookup, "subject_id")

    @cached_property
    def subjects_by_region(self) -> DataFrame:
        """Subject ids in one folder for each region, for lookups by that second key."""
        ids = self.wide.select("subject_id", "region_code")
        return replace_table(ids, scratch_path(self.spark, "by-region"), ["region_code"])

    @cached_property
    def monthly(self) -> DataFrame:
        """The monthly pre-aggregate of the mart, in one folder for each month."""
        return with_averages(self.monthly_store.read())

    @cached_property
    def monthly_store(self) -> PeriodStore:
        return store_monthly(self.mart, scratch_path(self.spark, "mart-monthly"))

    @cached_property
    def metric_rollup(self) -> Rollup:
        """Application metrics by all declared dimensions but the ids, in one folder for each month."""
        table = application_metrics()
        dimensions = ["region", "product", "lender", "channel", "decision"]
        return Rollup.build(self.applications, table, dimensions, scratch_path(self.spark, "metric-rollup"))

    @cached_property
    def mart(self) -> ApplicationMart:
        return ApplicationMart(
            self.applications, self.region, self.product, self.lender,
            self.scores, self.subjects,
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """One scored request per event: time, subject, probability, class and known outcome."""
        requests = self.raw("events").select(
            "event_id", F.col("ts").alias("scored_at"), F.col("user_id").alias("subject_id"), "value"
        )
        known = self.subjects.select("subject_id", "pd_true_prob", "default_flag")
        return materialize(
            left_join_lookups(requests, [known], "subject_id", "event_id", self.hot_users), "predictions"
        )

    @cached_property
    def hot_users(self) -> HotKeys:
        """The subjects with very many events, counted once for all joins of events with subjects."""
        return hot_keys(self.raw("events"), "user_id")


def _int(column: Column) -> Column:
    return column.cast("int")


_STAGED: dict[tuple, CreditTables] = {}


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder, in whatever store Spark reads it from."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def credit_tables(spark: SparkSession, folder: str) -> CreditTables:
    """The staged tables of `folder` as its files are now, kept for the life of the Spark application."""
    key = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if key not in _STAGED:
        _STAGED[key] = CreditTables(spark, folder)
    return _STAGED[key]
