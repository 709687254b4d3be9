"""Running energy balance of each vehicle, never below zero.

The drain of a step cannot be negative, so a balance that reaches zero stays there, and the balance
after a step is the start minus the drain so far, cut off at zero. Drains are added as whole
billionths: the sums are exact, and do not depend on the order in which tasks deliver them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallystream import fixed_values as fixed
from tallystream.functions.numeric import clamp
from tallystream.session import ROWS_PER_TASK, scratch, shuffle_tasks, spread

UNIT = 1_000_000_000


def drain_units(speed: Column) -> Column:
    bounded = clamp(F.coalesce(speed, F.lit(0.0)), fixed.SPEED_MIN, fixed.SPEED_MAX)
    return F.round(bounded * fixed.DRAIN_PER_KMH * UNIT).cast("bigint")


def in_units(amount: Column) -> Column:
    return F.round(amount * UNIT).cast("bigint")


def two_places(units: Column) -> Column:
    """Units, not below zero, as a number with two places, rounded half up on whole numbers."""
    cent = UNIT // 100
    shifted = units + cent // 2
    return (shifted - shifted % cent) / F.lit(cent) / F.lit(100.0)


def running_drain(df: DataFrame, *, vehicle: str, order: list[str], units: str, into: str,
                  rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Sum of ``units`` per vehicle up to each row; ``order`` must be unique within a vehicle.

    Vehicles that fit a task take one shuffle. Those with more rows are set apart and summed in
    ranges. The list that tells them apart is joined without a hint: adaptive execution broadcasts it
    while its measured size allows and splits skewed tasks where not.
    """
    sizes = df.groupBy(vehicle).agg(F.count(F.lit(1)).alias("n"))
    large = F.col("n") > rows_per_task
    total, in_large = sizes.agg(F.sum("n"), F.sum(F.when(large, F.col("n")))).first()
    if not in_large:
        return _summed_by_vehicle(df, vehicle, order, units, into, total or 0, rows_per_task)
    listed = sizes.where(large).select(F.col(vehicle).alias("__large"))
    is_listed = F.col(vehicle).eqNullSafe(F.col("__large"))
    rest = _summed_by_vehicle(df.join(listed, is_listed, "left_anti"), vehicle, order, units, into,
                              total - in_large, rows_per_task)
    return rest.unionByName(_summed_by_range(df.join(listed, is_listed, "left_semi"), vehicle, order, units, into,
                                             in_large, rows_per_task))


def _summed_by_vehicle(df: DataFrame, vehicle: str, order: list[str], units: str, into: str,
                       rows: int, rows_per_task: int) -> DataFrame:
    so_far = Window.partitionBy(vehicle).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    by_vehicle = spread(df, rows, vehicle, rows_per_task=rows_per_task)
    return by_vehicle.withColumn(into, F.sum(units).over(so_far))


def _summed_by_range(df: DataFrame, vehicle: str, order: list[str], units: str, into: str,
                     rows: int, rows_per_task: int) -> DataFrame:
    """Cut the rows into ranges of (vehicle, order), sum within each, and add what came before it.

    Only the first vehicle of a range can have rows in earlier ranges, so what came before is at most
    one row per range; it is joined on vehicle and range, which the sums within a range are placed by.
    Ranges are cut from a sample, and a second run may cut elsewhere: they are written down once.
    """
    spark = df.sparkSession
    folder = scratch(spark, "ranges")
    (df.repartitionByRange(max(shuffle_tasks(spark), math.ceil(rows / rows_per_task)), vehicle, *order)
     .withColumn("__range", F.spark_partition_id()).write.parquet(folder))
    ranges = spark.read.schema(StructType([*df.schema, StructField("__range", IntegerType())])).parquet(folder)
    earlier = Window.partitionBy(vehicle).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranges.groupBy(vehicle, "__range").agg(F.sum(units).alias("__sum"))
              .select(F.col(vehicle).alias("__first"), F.col("__range").alias("__in"),
                      F.sum("__sum").over(earlier).alias("__before"))
              .where(F.col("__before").isNotNull()))
    within = Window.partitionBy(vehicle, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = spread(ranges, rows, vehicle, "__range", rows_per_task=rows_per_task) \
        .withColumn("__within", F.sum(units).over(within))
    return (summed.join(before, (F.col("__range") == F.col("__in"))
                        & F.col(vehicle).eqNullSafe(F.col("__first")), "left")
            .withColumn(into, F.col("__within") + F.coalesce(F.col("__before"), F.lit(0)))
            .select(*df.columns, into))


def energy_balance(df: DataFrame, *, vehicle: str, order: list[str], speed: str, start: Column,
                   into: str = "battery_kwh", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add the balance after each step, rounded to two places in the output only.

    ``start`` is computed after the shuffle; what else can be computed from the columns should be, too.
    """
    steps = df.withColumn("__units", drain_units(F.col(speed)))
    summed = running_drain(steps, vehicle=vehicle, order=order, units="__units", into="__drained",
                           rows_per_task=rows_per_task)
    left = F.greatest(in_units(start) - F.col("__drained"), F.lit(0).cast("bigint"))
    return summed.withColumn(into, two_places(left)).drop("__units", "__drained")
