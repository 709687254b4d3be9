"""Grouped reports, samples, counts and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream import fixed_values as fixed
from tallystream.functions.text import shown_width, truncated_cell


def revenue_by_type(df: DataFrame, kind: str, amount: str) -> DataFrame:
    """Rows and total amount per type, highest total first; the type breaks ties."""
    return (df.groupBy(F.col(kind).alias("violation_type"))
            .agg(F.count(F.lit(1)).alias("ticket_amount"), F.sum(amount).alias("total_revenue"))
            .orderBy(F.desc_nulls_last("total_revenue"), F.asc("violation_type")))


def first_rows(df: DataFrame, *order: str, rows: int = fixed.SAMPLE_ROWS) -> DataFrame:
    """The first rows in the order of the given columns."""
    return df.orderBy(*order).limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def preview(df: DataFrame, *order: str | Column, rows: int = fixed.PREVIEW_ROWS,
            width: int = fixed.PREVIEW_WIDTH) -> DataFrame:
    """The first rows as the text a preview shows: at most ``width`` characters per cell."""
    return df.orderBy(*order).limit(rows).select(
        [truncated_cell(F.col(name), width).alias(name) for name in df.columns])


def shown_text(df: DataFrame, *order: str | Column, rows: int = fixed.PREVIEW_ROWS,
               width: int = fixed.PREVIEW_WIDTH) -> DataFrame:
    """(line, text): the drawn table of a preview, line by line, the way a shell shows it.

    Columns are as wide as their widest cell, name or three characters, cells stand at the right, and characters that
    fill two places count twice. Only the previewed rows, at most ``rows`` and one more to know whether there are
    others, come together in one task.
    """
    taken = df.orderBy(*order).limit(rows + 1)
    at = F.row_number().over(Window.orderBy(*order)) if order else F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    cells = taken.select(at.alias("n"), F.array(*[truncated_cell(F.col(f"`{name}`"), width) for name in df.columns]).alias("cells"))
    named = F.lit(df.columns)
    # One row: the preview as arrays, and whether there was a row more.
    whole = cells.agg(F.sort_array(F.collect_list(F.when(F.col("n") <= rows, F.struct("n", "cells")))).alias("body"),
                      (F.max("n") > rows).alias("more"))
    places = F.sequence(F.lit(0), F.lit(len(df.columns) - 1))
    widths = F.transform(places, lambda k: F.array_max(F.concat(
        F.array(F.lit(3), shown_width(F.get(named, k))), F.transform("body", lambda r: shown_width(F.get(r["cells"], k))))))

    def line(cells: Column) -> Column:
        padded = F.zip_with(cells, F.col("widths"), lambda c, w: F.concat(F.repeat(F.lit(" "), w - shown_width(c)), c))
        return F.concat(F.lit("|"), F.array_join(padded, "|"), F.lit("|"))

    rule = F.concat(F.lit("+"), F.array_join(F.transform("widths", lambda w: F.repeat(F.lit("-"), w)), "+"), F.lit("+"))
    end = F.when(F.coalesce("more", F.lit(False)), F.array(F.lit(f"only showing top {rows} row{'s' if rows != 1 else ''}"))).otherwise(
        F.array().cast("array<string>"))
    lines = F.concat(F.array(rule, line(named), rule), F.transform("body", lambda r: line(r["cells"])), F.array(rule), end)
    return whole.withColumn("widths", widths).select(F.posexplode(lines).alias("line", "text"))


def list_partitions(df: DataFrame, column: str) -> DataFrame:
    """Values of a partition column with their row counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
