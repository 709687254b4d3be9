"""Batch sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the provided tables, with the schema that its files have now."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def key_range(spark: SparkSession, keys: DataFrame, column: str, low: int | None = None, high: int | None = None,
              most_per_key: int = 1000) -> DataFrame:
    """Every whole number from ``low`` to ``high`` as column ``id``; by default from the smallest key to the largest.

    Only bounds and a count reach the driver; the numbers are made in parallel. A domain with more than
    ``most_per_key`` numbers for each key is refused: single keys far apart would ask for rows without end.
    """
    least, most, n = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    low, high = least if low is None else low, most if high is None else high
    if low is None or high is None:
        return spark.range(0)
    if high - low + 1 > max(n, 1) * most_per_key:
        raise ValueError(f"{high - low + 1} numbers for {n} keys; give bounds, or allow more numbers per key")
    return spark.range(low, high + 1)


def constant_rows(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """Rows written out in the program, with their types (and null rules) given."""
    return spark.createDataFrame(rows, schema)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Give rows the names and types of a schema; null in a required column fails the job."""

    def field(spec) -> Column:
        value = F.col(spec.name).cast(spec.dataType)
        if not spec.nullable:
            value = F.when(value.isNotNull(), value).otherwise(
                F.raise_error(F.lit(f"null in required column {spec.name}")).cast(spec.dataType))
        return value.alias(spec.name)

    return df.select([field(spec) for spec in schema])
