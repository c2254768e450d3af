"""Delimited text in, typed DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.fixed_values import NULL_TOKENS
from riskloom.sources.tables import append_table


def read_text_fields(
    spark: SparkSession, path: str, names: list[str], multi_line: bool = False
) -> DataFrame:
    """All fields as strings: one header line skipped, optional double quotes, NULL tokens mapped.

    Compression follows the file suffix. `multi_line` allows line breaks inside quotes but makes
    each file one task, so it is off unless asked for.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(schema).csv(
        path, sep=",", header=True, quote='"', escape='"', mode="FAILFAST",
        enforceSchema=True, multiLine=multi_line,
    )
    return raw.select(
        *[F.when(~F.col(n).isin(NULL_TOKENS), F.col(n)).alias(n) for n in names]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared types by name; a value that does not fit raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    return conform(read_text_fields(spark, path, schema.fieldNames(), multi_line), schema)


def append_delimited(spark: SparkSession, path: str, schema: T.StructType, table_path: str) -> None:
    """Append the rows of a file to a table, also when that file was loaded before."""
    append_table(read_delimited(spark, path, schema), table_path)


def write_delimited(df: DataFrame, path: str, null_token: str = "NULL") -> None:
    df.write.csv(path, header=True, quote='"', escape='"', nullValue=null_token)
