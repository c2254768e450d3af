"""Dummy columns, scaling and model input assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import columns as c
from riskloom.functions import fixed_values as fv
from riskloom.functions.naming import clean_names


def with_dti(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "dti_ratio", c.dti_ratio(F.col("monthly_installment"), F.col("monthly_income"))
    )


def split_by_type(df: DataFrame, id_: str, label: str | None = None) -> tuple[list[str], list[str]]:
    """(categorical, numeric) column names: strings against everything else."""
    skipped = {id_, label}
    fields = [f for f in df.schema.fields if f.name not in skipped]
    categorical = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return categorical, [f.name for f in fields if f.name not in categorical]


def learn_categories(
    df: DataFrame, columns: list[str], max_values: int = 10_000
) -> dict[str, list[str]]:
    """Sorted non-NULL values per column, collected only after their number is known to be small."""
    if not columns:
        return {}
    sizes = df.agg(*[F.approx_count_distinct(col).alias(col) for col in columns]).first()
    too_wide = [col for col in columns if sizes[col] > max_values]
    if too_wide:
        raise ValueError(f"more than {max_values} categories: {too_wide}")
    sets = df.agg(*[F.array_sort(F.collect_set(col)).alias(col) for col in columns]).first()
    return {col: list(sets[col]) for col in columns}


def dummies(categories: dict[str, list[str]]) -> list[Column]:
    """One 0/1 double per (column, value), values in alphabetical order; NULL gives 0 everywhere."""
    pairs = [(col, value) for col, values in categories.items() for value in sorted(values)]
    names = [n.lower() for n in clean_names([f"{col}_{value}" for col, value in pairs])]
    return [
        F.when(F.col(col) == value, 1.0).otherwise(0.0).alias(name)
        for (col, value), name in zip(pairs, names)
    ]


def onehot(df: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """Replace the categorical columns by their dummies in one projection."""
    kept = [F.col(f"`{n}`") for n in df.columns if n not in categories]
    return df.select(*kept, *dummies(categories))


def scoring_view(subjects: DataFrame, categories: dict[str, list[str]] | None = None) -> DataFrame:
    """The id and the 60 model inputs in signature order: dummies, numerics, debt-to-income."""
    return with_dti(subjects).select(
        "subject_id", *dummies(categories or fv.SCORING_CATEGORIES), *fv.SCORING_NUMERICS, "dti_ratio"
    )


def fill_zero(df: DataFrame) -> DataFrame:
    return df.fillna(0)


def scale_parameters(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column; a constant column keeps a scale of 1."""
    stats = df.agg(
        *[F.avg(col).alias(f"m_{col}") for col in columns],
        *[F.stddev_pop(col).alias(f"s_{col}") for col in columns],
    ).first()
    return {col: (stats[f"m_{col}"], stats[f"s_{col}"] or 1.0) for col in columns}


def standard_scale(df: DataFrame, parameters: dict[str, tuple[float, float]]) -> DataFrame:
    """z-scores with parameters learned elsewhere; other columns stay as they are."""
    return df.select(
        *[
            ((F.col(n) - parameters[n][0]) / parameters[n][1]).alias(n) if n in parameters else n
            for n in df.columns
        ]
    )
