from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallystream.operators import branches
from tallystream.session import settings as session_settings

REFS = "branch string, created_seq bigint, dropped_seq bigint"
CHANGES = "branch string, seq bigint, op string, name string, salary int"
BASE = "name string, salary int"


def state(spark, base, refs, log, branch):
    rows = branches.read_branch(
        spark.createDataFrame(base, BASE), spark.createDataFrame(refs, REFS), spark.createDataFrame(log, CHANGES),
        branch, key="name", values=["salary"])
    assert rows.columns == ["name", "salary"]
    return Counter(map(tuple, rows.collect()))


def folded(base, refs, log, branch):
    """The same, one change after the other."""
    starts = [created for name, created, dropped in refs if name == branch and dropped is None]
    if not starts:
        return Counter()
    start = min(starts)
    rows = list(base)
    for owner, seq, op, name, salary in sorted(log, key=lambda change: change[1]):
        own = owner == branch and seq > start
        inherited = branch != "main" and owner == "main" and seq <= start
        if not (own or inherited):
            continue
        if op == "insert":
            rows.append((name, salary))
        elif op == "delete":
            rows = [row for row in rows if name is None or row[0] != name]
        else:
            rows = [(row[0], salary) if name is not None and row[0] == name else row for row in rows]
    return Counter(rows)


BASE_ROWS = [("Alice", 100000), ("Bob", 120000)]
OPEN = [("main", 0, None), ("experiment", 10, None)]
MISTAKE = [("experiment", 11, "delete", "Alice", None), ("experiment", 12, "insert", "Charlie", 500)]


def test_scenario(spark):
    assert state(spark, BASE_ROWS, OPEN, [], "experiment") == Counter(BASE_ROWS)
    assert state(spark, BASE_ROWS, OPEN, MISTAKE, "experiment") == Counter([("Bob", 120000), ("Charlie", 500)])
    assert state(spark, BASE_ROWS, OPEN, MISTAKE, "main") == Counter(BASE_ROWS)
    dropped = [("main", 0, None), ("experiment", 10, 20)]
    assert state(spark, BASE_ROWS, dropped, MISTAKE, "experiment") == Counter()
    assert state(spark, BASE_ROWS, dropped + [("experiment", 30, None)], MISTAKE, "experiment") == Counter(BASE_ROWS)
    assert state(spark, BASE_ROWS, OPEN + [("experiment", 15, None)], MISTAKE, "experiment") == \
        Counter([("Bob", 120000), ("Charlie", 500)])


def test_recorded_statements(spark):
    base = spark.createDataFrame(BASE_ROWS, BASE)
    refs = branches.create_branch(spark.createDataFrame(OPEN[:1], REFS), "experiment", 10)
    how = {"key": "name", "values": ["salary"]}
    log = branches.record(base.where("name = 'Alice'"), "delete", 11, "experiment", **how)
    log = log.unionByName(branches.record(spark.sql("SELECT 'Charlie' AS name, 500 AS salary"), "insert", 12, "experiment", **how))
    log = log.unionByName(branches.record(base.where("name = 'Alice'"), "delete", 13, **how))
    log = log.unionByName(branches.record(spark.sql("SELECT 'Bob' AS name, 1 AS salary"), "update", 14, **how))
    read = {name: Counter(map(tuple, branches.read_branch(base, refs, log, *name, **how).collect()))
            for name in [(), ("experiment",)]}
    assert read == {(): Counter([("Bob", 1)]), ("experiment",): Counter([("Bob", 120000), ("Charlie", 500)])}
    with pytest.raises(ValueError):
        branches.record(base, "merge", 15, **how)


def test_branches_are_made_and_dropped(spark):
    base, log = spark.createDataFrame(BASE_ROWS, BASE), spark.createDataFrame(MISTAKE, CHANGES)

    def names(refs):
        rows = branches.read_branch(base, refs, log, "experiment", key="name", values=["salary"]).collect()
        return sorted(row.name for row in rows)

    refs = branches.create_branch(spark.createDataFrame(OPEN[:1], REFS), "experiment", 10)
    assert names(refs) == ["Bob", "Charlie"]
    assert names(branches.create_branch(refs, "experiment", 15)) == ["Bob", "Charlie"]
    dropped = branches.drop_branch(branches.create_branch(refs, "experiment", 15), "experiment", 20)
    assert names(dropped) == []
    assert names(branches.create_branch(dropped, "experiment", 30)) == ["Alice", "Bob"]


@pytest.mark.parametrize("log, expected", [
    ([("experiment", 11, "delete", "Alice", None), ("experiment", 13, "insert", "Alice", 7)],
     {("Alice", 7): 1, ("Bob", 120000): 1}),
    ([("experiment", 11, "insert", "Alice", 7), ("experiment", 13, "delete", "Alice", None)], {("Bob", 120000): 1}),
    ([("experiment", 11, "delete", None, None)], {("Alice", 100000): 1, ("Bob", 120000): 1}),
    ([("experiment", 11, "update", "Bob", None)], {("Alice", 100000): 1, ("Bob", None): 1}),
])
def test_order_of_changes(spark, log, expected):
    assert state(spark, BASE_ROWS, OPEN, log, "experiment") == Counter(expected)


names = st.sampled_from(["a", "b", "c", None])
salaries = st.one_of(st.none(), st.integers(0, 3))


@st.composite
def histories(draw):
    base = draw(st.lists(st.tuples(names, salaries), max_size=8)) + [("a", 1)]
    refs = [("main", 0, None)] + [
        ("x", created, created + length if length else None)
        for created, length in draw(st.lists(st.tuples(st.integers(1, 20), st.integers(0, 9)), max_size=3))]
    changes = draw(st.lists(st.tuples(st.sampled_from(["main", "x", "y"]),
                                      st.sampled_from(["insert", "delete", "update"]), names, salaries), max_size=25))
    log = [(branch, seq, op, name, salary) for seq, (branch, op, name, salary) in enumerate(changes, 1)]
    return base, refs, log + [("y", 99, "delete", "a", None)]


@hypothesis_settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(histories(), st.sampled_from(["main", "x"]))
def test_state_is_the_fold_of_the_changes(spark, history, branch):
    assert state(spark, *history, branch) == folded(*history, branch)


def test_differences_count_copies(spark):
    left = spark.createDataFrame([(1,)] * 5 + [(2,), (None,)], "a int")
    right = spark.createDataFrame([(1,)] * 2 + [(3,), (None,)], "a int")
    assert Counter(map(tuple, branches.row_differences(left, right).collect())) == Counter([(1, 3), (2, 1), (3, -1)])


def test_keys_with_many_rows_are_joined_whole(spark):
    """A third of the rows has one key and another third has none; the log is joined by a shuffle."""
    rows = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500)).alias("name"),
        F.col("id").cast("int").alias("salary"))
    log = rows.where("name IS NOT NULL AND name <> 'k1'").select("name").distinct().select(
        F.lit("main").alias("branch"), F.lit(1).cast("bigint").alias("seq"), F.lit("update").alias("op"), "name", F.lit(5).alias("salary"))
    with session_settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        read = branches.read_branch(rows, spark.createDataFrame(OPEN, REFS), log, key="name", values=["salary"])
        expected = rows.withColumn("salary", F.when(F.col("name").isNotNull() & (F.col("name") != "k1"), 5).otherwise(F.col("salary")))
        assert branches.row_differences(read, expected).isEmpty() and read.count() == 9000
        assert "Broadcast" not in read._jdf.queryExecution().executedPlan().toString()
