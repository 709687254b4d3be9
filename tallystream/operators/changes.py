"""Deletes and updates by predicate: as the rows of the table after the change, or in the partitions it touches.

The rows after a change are a map over those before: no shuffle. A predicate that is null for a row leaves the row
alone. Write them to a new folder: Spark refuses to overwrite a table that the same job reads.

A change in place first looks which partitions hold rows that the predicate selects, reading the predicate's columns
alone, and then reads and overwrites only these; all other files stay as they are. Each partition changes when the
job that writes it is finished. A delete that was cut off can be run again.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.operators.writes import described
from tallystream.sources import paths

#: Most files that a partition changed in place is written to.
FILES = 8


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Set columns where the condition holds; all expressions see the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select([
        F.when(hit, assignments[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        if f.name in assignments else F.col(f.name)
        for f in df.schema])


def _touched(rows: DataFrame, condition: Column, partition: str) -> list[tuple[object, str]]:
    """Values of the partition column that hold selected rows, with their folders: a row per partition."""
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    return [tuple(r) for r in rows.where(condition).select(partition, folder).distinct().collect()]


def _overwrite(rows: DataFrame, name: str, partition: str) -> None:
    """Write the partitions that the rows have, and no others, of the table that they are read from.

    Spark writes them beside the table and puts them in place when all rows are read and written. A large partition
    is dealt to several tasks.
    """
    facts = described(rows.sparkSession, name)
    piece = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(FILES))
    (rows.repartition(partition, piece).write.format(facts["Provider"]).partitionBy(partition)
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").save(facts["Location"]))


def _change(spark: SparkSession, name: str, condition: Column, partition: str, changed) -> list[object]:
    rows = spark.table(name)
    found = _touched(rows, condition, partition)
    if not found:
        return []
    some = [value for value, _ in found if value is not None]
    inside = F.col(partition).isin(some) | (F.col(partition).isNull() if len(some) < len(found) else F.lit(False))
    after = changed(rows.where(inside))
    left = {r[0] for r in after.select(partition).distinct().collect()}
    if left:
        _overwrite(after, name, partition)
    for value, folder in found:
        if value not in left:
            paths.remove(spark, unquote(folder))
    spark.catalog.refreshTable(name)
    return sorted((value for value, _ in found), key=str)


def delete_in_place(spark: SparkSession, name: str, condition: Column, partition: str) -> list[object]:
    """Delete rows of a table that is stored by a partition column; returns the values whose partitions were touched.

    A partition that loses all its rows goes as a folder.
    """
    return _change(spark, name, condition, partition, lambda rows: delete_where(rows, condition))


def update_in_place(spark: SparkSession, name: str, condition: Column, partition: str,
                    assignments: dict[str, Column]) -> list[object]:
    """Set columns of selected rows; the partition column cannot be one, as rows would move to other partitions."""
    if partition in assignments:
        raise ValueError(f"{partition} says where a row is stored and cannot be set in place")
    return _change(spark, name, condition, partition, lambda rows: update_where(rows, condition, assignments))
