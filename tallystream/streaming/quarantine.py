"""Why a line was set aside: which of its fields do not fit, and what the others hold.

A line is opened once as a variant, without a schema. Each field is then looked at by itself, by the rules that the
stream reads fields by: what it holds must be of a kind that its type takes, and must be a value of that type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

NOT_JSON, NOT_OBJECT, UNKNOWN = "not json", "not an object", "unknown"
_WHOLE = ["BIGINT"]
_NUMBER = ["BIGINT", "DOUBLE", "FLOAT", "DECIMAL"]
#: Kinds of JSON values that a field of a type is read from; a field of any other type takes any kind.
_TAKES = {"tinyint": _WHOLE, "smallint": _WHOLE, "int": _WHOLE, "bigint": _WHOLE, "float": _NUMBER, "double": _NUMBER,
          "boolean": ["BOOLEAN"], "timestamp": ["STRING"], "date": ["STRING"]}
#: Texts that stand for numbers JSON has no way to write.
_NUMBER_TEXTS = ["NaN", "Infinity", "+Infinity", "-Infinity", "INF", "+INF", "-INF"]


def _path(name: str) -> str:
    if "'" in name and '"' in name:
        raise ValueError(f"a field with both kinds of quotes cannot be looked up: {name}")
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def _value(line: Column, field: StructField) -> Column:
    return F.try_variant_get(line, _path(field.name), field.dataType.simpleString())


def _fails(line: Column, field: StructField) -> Column:
    """Whether the field is there, is not null, and cannot be read."""
    inner = F.try_variant_get(line, _path(field.name), "variant")
    there = inner.isNotNull() & ~F.coalesce(F.is_variant_null(inner), F.lit(True))
    kind = F.regexp_extract(F.schema_of_variant(inner), "^[A-Z]+", 0)
    takes = _TAKES.get(field.dataType.simpleString())
    fits = _value(line, field).isNotNull()
    if takes:
        right = kind.isin(takes)
        if takes is _NUMBER:
            right = right | ((kind == "STRING") & inner.cast("string").isin(_NUMBER_TEXTS))
        fits = fits & right
    return there & ~F.coalesce(fits, F.lit(False))


def explain(lines: DataFrame, schema: StructType, column: str = "line") -> DataFrame:
    """The lines with ``reason``, ``failed`` (names of fields that do not fit) and ``kept`` (the others, typed).

    ``reason`` is the names of the failed fields, joined by commas, or says that the line is no JSON or no object, or
    that no field explains it. In ``kept`` failed and missing fields are null.
    """
    opened = lines.withColumn("__v", F.try_parse_json(F.col(column)))
    line = F.col("__v")
    is_object = F.startswith(F.schema_of_variant(line), F.lit("OBJECT"))
    named = F.array_compact(F.array(*[F.when(_fails(line, f), F.lit(f.name)) for f in schema]))
    failed = F.when(is_object, named).otherwise(F.array().cast("array<string>"))
    kept = F.struct(*[F.when(is_object & ~F.array_contains("failed", f.name), _value(line, f)).alias(f.name) for f in schema])
    reason = (F.when(line.isNull(), NOT_JSON).when(~is_object, NOT_OBJECT)
              .when(F.size("failed") == 0, UNKNOWN).otherwise(F.array_join("failed", ",")))
    return opened.withColumn("failed", failed).withColumns({"reason": reason, "kept": kept}).drop("__v")
