"""Feature views, training sets, lookup tables and request enrichment."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import fixed_values as fv
from riskloom.operators.encode import with_dti
from riskloom.operators.joins import left_join_lookups
from riskloom.sources.tables import replace_table, scan


def core_features(subjects: DataFrame) -> DataFrame:
    """Subject id, the 33 stored core features and the debt-to-income ratio."""
    return with_dti(subjects).select("subject_id", *fv.CORE_FEATURES, "dti_ratio")


@dataclass(frozen=True)
class FeatureView:
    """A named, versioned feature query with its entity key, descriptions and refresh interval."""

    name: str
    key: str
    features: DataFrame
    version: str = "1"
    refresh: str = "1 day"
    description: str = ""
    feature_descriptions: dict[str, str] = field(default_factory=dict)

    def described(self) -> DataFrame:
        """The features with their descriptions in the column metadata."""
        return self.features.select(
            *[
                F.col(n).alias(n, metadata={"comment": self.feature_descriptions[n]})
                if n in self.feature_descriptions else F.col(n)
                for n in self.features.columns
            ]
        )

    def path(self, root: str) -> str:
        return f"{root}/{self.name}/version={self.version}"

    def register(self, root: str) -> DataFrame:
        """Materialize this version, replacing an earlier run of it."""
        return replace_table(self.described(), self.path(root))

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        return scan(spark, self.path(root))


def credit_bureau_features(subjects: DataFrame) -> FeatureView:
    return FeatureView(
        name="CREDIT_BUREAU_FEATURES",
        key="subject_id",
        features=core_features(subjects),
        description="What the bureau knows about a subject, as model inputs",
        feature_descriptions=fv.FEATURE_DESCRIPTIONS,
    )


def training_set(spine: DataFrame, views: list[FeatureView]) -> DataFrame:
    """Spine (key, label) with the columns of every view attached on the entity key.

    Every spine row is kept; the spine is unique by key, so no key can be hot.
    """
    key = views[0].key
    return left_join_lookups(spine, [v.features for v in views], key, key, hot=[])


def dataset_snapshot(
    spine: DataFrame, views: list[FeatureView], root: str, name: str = "PD_TRAINING_SET"
) -> DataFrame:
    """Write the training set under its name, replacing the earlier snapshot."""
    return replace_table(training_set(spine, views), f"{root}/{name}")


def lookup_table(subjects: DataFrame) -> DataFrame:
    """The key and the 60 columns served to decision requests."""
    return subjects.select("subject_id", *fv.LOOKUP_FEATURES)
