"""Expression and predicate evaluators over DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import predicate

OUTPUT = "output"


@dataclass(frozen=True)
class ExpressionEvaluator:
    """Evaluates an expression for each row: a struct becomes columns, anything else a column named output.

    A wrong expression is reported by evaluate, not on creation.
    """

    input_schema: T.StructType
    expression: predicate.Expr
    output_type: T.DataType

    def evaluate(self, rows: DataFrame) -> DataFrame:
        if isinstance(self.expression, predicate.Struct):
            value = predicate.to_column(self.expression, self.output_type, self.input_schema)
            return rows.select(value.alias("s")).select("s.*").select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.output_type.fields))
        return rows.select(predicate.to_column(self.expression, schema=self.input_schema).cast(self.output_type).alias(OUTPUT))


@dataclass(frozen=True)
class PredicateEvaluator:
    """Evaluates a predicate to a boolean column named output; rows are not filtered."""

    input_schema: T.StructType
    predicate: predicate.Expr

    def evaluate(self, rows: DataFrame) -> DataFrame:
        return rows.select(predicate.to_column(self.predicate, schema=self.input_schema).cast("boolean").alias(OUTPUT))


def null_row(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row of NULLs."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame([tuple(None for _ in schema.fields)], nullable)
