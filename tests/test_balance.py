import random
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallystream.operators.balance import energy_balance

SCHEMA = "vehicle int, ts bigint, event_id bigint, speed double, start double"


def stepwise(rows):
    """The balance after each step, one step after the other, in exact decimals."""
    balances, result = {}, {}
    for vehicle, ts, event_id, speed, start in sorted(rows, key=lambda r: (r[1], r[2])):
        bounded = min(max(Decimal(str(speed if speed is not None else 0)), Decimal(0)), Decimal(120))
        left = max(balances.get(vehicle, Decimal(str(start))) - bounded * Decimal("0.001"), Decimal(0))
        balances[vehicle] = left
        result[event_id] = float(left.quantize(Decimal("0.01"), ROUND_HALF_UP))
    return result


def readings(seed, n, hot_share=0.4):
    rng = random.Random(seed)
    rows = []
    for event_id in range(n):
        vehicle = rng.choice([0, None]) if rng.random() < hot_share else rng.randrange(1, 12)
        speed = rng.choice([None, -3.0, 500.0]) if rng.random() < 0.05 else round(rng.uniform(0, 120), 2)
        rows.append((vehicle, rng.randrange(50), event_id, speed, 2.0 if vehicle == 0 else 85.0))
    return rows


@pytest.mark.parametrize("rows_per_task", [5_000_000, 60, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_balance_is_the_stepwise_one(spark, seed, rows_per_task):
    rows = readings(seed, 900)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    result = energy_balance(df, vehicle="vehicle", order=["ts", "event_id"], speed="speed", start=F.col("start"),
                            rows_per_task=rows_per_task)
    assert result.columns == [*df.columns, "battery_kwh"]
    assert {r.event_id: r.battery_kwh for r in result.collect()} == stepwise(rows)
    assert result.agg(F.min("battery_kwh")).first()[0] == 0.0


def test_a_hot_vehicle_is_cut_into_ranges(spark):
    rows = spark.range(0, 4000).select(F.lit(1).alias("vehicle"), F.lit(0).cast("bigint").alias("ts"),
                                       F.col("id").alias("event_id"), F.lit(1.0).alias("speed"), F.lit(100.0).alias("start"))
    result = energy_balance(rows, vehicle="vehicle", order=["ts", "event_id"], speed="speed", start=F.col("start"),
                            rows_per_task=500)
    assert result.where("event_id = 3999").first().battery_kwh == 96.0
    assert "__range" in result._jdf.queryExecution().executedPlan().toString()


def test_many_vehicles_get_enough_tasks(spark):
    rows = [(n % 60, n // 60, n, 60.0, 85.0) for n in range(600)]
    result = energy_balance(spark.createDataFrame(rows, SCHEMA), vehicle="vehicle", order=["ts", "event_id"],
                            speed="speed", start=F.col("start"), rows_per_task=20)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and re.search(r"hashpartitioning\(vehicle#\d+, 30\)", plan)
    assert {r.event_id: r.battery_kwh for r in result.collect()} == stepwise(rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert energy_balance(empty, vehicle="vehicle", order=["ts", "event_id"], speed="speed", start=F.col("start")).count() == 0
