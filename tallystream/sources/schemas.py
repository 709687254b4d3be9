"""Schemas written as name and type, usable before a session exists."""

from __future__ import annotations

from pyspark.sql import types as T

from tallystream import fixed_values as fixed

_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
          "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def schema_of(columns: dict[str, str], required: bool = False) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], not required) for name, kind in columns.items()])


TELEMETRY = schema_of(fixed.TELEMETRY_COLUMNS)
