"""What the plans of the registered queries must and must not contain."""

import re

import pytest

from conftest import SF_DIR
from tallystream.plans.catalog import QUERIES
from tallystream.session import settings


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_and_no_python_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "Scan ExistingRDD"]:
        assert operator not in plan


@pytest.mark.parametrize("name, columns", [
    ("revenue_by_type", ["l_linenumber", "l_returnflag"]), ("global_count", []), ("category_pick", ["o_custkey", "o_orderkey", "o_totalprice"]),
    ("tick_bucket", ["ts", "event_type"]), ("clamp_round", ["event_id", "value"]), ("list_partitions", []),
    ("small_file_audit", []), ("energy_balance", ["event_id", "ts", "user_id", "value"])])
def test_scans_read_the_columns_they_need(spark, name, columns):
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan_of(QUERIES[name](spark, SF_DIR))):
        assert sorted(re.findall(r"(\w+):", schema)) == sorted(columns)


def test_the_touched_partition_alone_is_read(spark, folder):
    from pyspark.sql import functions as F
    from tallystream.operators import changes, writes
    name = "t_" + folder.rsplit("/", 1)[1].replace("-", "_")
    writes.create_or_replace(spark.read.parquet(f"{SF_DIR}/orders.parquet"), name, partition_by=["o_orderstatus"], location=f"{folder}/t")
    rows = spark.table(name).where(F.col("o_totalprice") > 5).select("o_orderstatus", "_metadata.file_path")
    assert "ReadSchema: struct<o_totalprice:double>" in plan_of(rows)
    assert changes.delete_in_place(spark, name, F.col("o_orderkey") < -1, "o_orderstatus") == []


@pytest.mark.parametrize("name", ["table_scan", "derived_projection", "category_pick", "clamp_round", "vehicle_key",
                                  "json_props", "update_where", "statement_clean", "statement_split",
                                  "statement_guard", "guard_outcome", "epoch_offset_timestamp"])
def test_maps_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name, shuffles", [("revenue_by_type", 2), ("global_count", 1), ("tick_bucket", 1),
                                            ("energy_balance", 1), ("list_partitions", 1), ("small_file_audit", 2)])
def test_number_of_shuffles(spark, name, shuffles):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", plan)) == shuffles


def test_groups_are_added_up_before_the_shuffle(spark):
    for name in ["revenue_by_type", "tick_bucket", "list_partitions"]:
        assert "partial_count" in plan_of(QUERIES[name](spark, SF_DIR))


def test_no_broadcast_is_forced(spark):
    """Without small sides no join sends a side around: not the branch log, not the list of large vehicles, nor the sums before a range."""
    from tallystream.operators import balance, branches
    from tallystream.plans import inputs
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        branch = plan_of(branches.read_branch(
            inputs.customer_salaries(spark, SF_DIR).select("name", "salary"), inputs.branch_refs(spark),
            inputs.branch_changes(spark, SF_DIR), "experiment", key="name", values=["salary"]))
        readings = spark.read.parquet(f"{SF_DIR}/events.parquet")
        steps = plan_of(balance.energy_balance(readings, vehicle="user_id", order=["ts", "event_id"], speed="value",
                                               start=readings["value"], rows_per_task=7))
    for plan in (branch, steps):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan and "NestedLoop" not in plan


def test_each_state_is_resolved_once(spark):
    plan = plan_of(QUERIES["branch_isolation"](spark, SF_DIR))
    assert len(re.findall(r"FileScan", plan)) <= 7
