"""File readers with a schema given: missing columns are NULL, others are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import predicate
from .storage import glob_safe


def read_parquet_files(spark: SparkSession, files: list[str], schema: T.StructType, where: predicate.Expr | None = None) -> DataFrame:
    """Parquet files as rows of schema; where filters, and Spark prunes row groups by it. No files give no rows."""
    df = spark.read.schema(schema).parquet(*map(glob_safe, files)) if files else spark.createDataFrame([], schema)
    return df.where(predicate.to_column(where, schema=schema)) if where is not None else df


def read_json_files(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Files of a JSON object a line."""
    return spark.read.schema(schema).json([glob_safe(f) for f in files]) if files else spark.createDataFrame([], schema)


def parse_json(text: Column, schema: T.StructType) -> Column:
    """A string column as a struct; what does not parse is NULL in all fields."""
    return F.from_json(text, schema)
