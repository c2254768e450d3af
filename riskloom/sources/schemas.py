"""Declared schemas of the loaded tables."""

from pyspark.sql import types as T


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


DIM_REGION = T.StructType(_text("region_code", "region_name", "island_group"))
DIM_PRODUCT = T.StructType(_text("product_code", "product_name", "product_class"))
DIM_LENDER = T.StructType(_text("lender_code", "lender_name", "lender_type"))
LOAN_APPLICATIONS = T.StructType(
    _text("application_id", "subject_id")
    + [T.StructField("app_date", T.DateType())]
    + _text("region_code", "product_code", "lender_code", "channel")
    + [
        T.StructField("requested_amount", T.DecimalType(18, 0)),
        T.StructField("tenor_months", T.DecimalType(5, 0)),
    ]
    + _text("decision")
)
