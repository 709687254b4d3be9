"""What-if branches of a table, resolved when they are read.

A table is a base and a log of changes. ``refs(branch, created_seq, dropped_seq)`` says which branches
live; ``changes(branch, seq, op, <key>, <values>)`` holds inserts, deletes and updates by key. ``seq``
is one order over all branches, and main has ``created_seq`` 0. A branch sees main as it was at its
creation plus its own changes after that, so main never sees a change made on a branch.

A read names its branch: base and log are each filtered to that branch before anything is shuffled,
and the work does not grow with the number of other branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.operators.changes import update_where

MAIN = "main"
OPERATIONS = ("insert", "delete", "update")


def record(rows: DataFrame, operation: str, seq: int, branch: str = MAIN, *, key: str, values: list[str]) -> DataFrame:
    """Log entries for one statement: rows to insert, keys to delete, or keys with their new values.

    All entries of a statement have its ``seq``. A delete keeps the key only; an update has one row per key.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"{operation} is none of {OPERATIONS}")
    if operation == "delete":
        rows = rows.select(key, *[F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in values])
    return rows.select(F.lit(branch).alias("branch"), F.lit(seq).cast("bigint").alias("seq"),
                       F.lit(operation).alias("op"), key, *values)


def create_branch(refs: DataFrame, branch: str, seq: int) -> DataFrame:
    """Refs with a branch that starts from main as of ``seq``; a live one of that name goes on as it is."""
    row = refs.sparkSession.range(1).select(
        F.lit(branch).alias("branch"), F.lit(seq).cast("bigint").alias("created_seq"),
        F.lit(None).cast("bigint").alias("dropped_seq"))
    return refs.unionByName(row)


def drop_branch(refs: DataFrame, branch: str, seq: int) -> DataFrame:
    """Refs without the branch: its changes are not seen any more, not even when the name is used again."""
    live = (F.col("branch") == branch) & F.col("dropped_seq").isNull()
    return update_where(refs, live, {"dropped_seq": F.lit(seq)})


def created_at(refs: DataFrame, branch: str) -> Column:
    """Sequence number the live branch starts from, null when there is none.

    A second creation of a live branch has no effect, hence the smallest number.
    """
    live = refs.where((F.col("branch") == branch) & F.col("dropped_seq").isNull())
    return live.agg(F.min("created_seq")).scalar()


def visible_changes(refs: DataFrame, changes: DataFrame, branch: str = MAIN) -> DataFrame:
    """Changes a branch sees: its own since it was created, and those of main before that."""
    start = created_at(refs, branch)
    own = (F.col("branch") == branch) & (F.col("seq") > start)
    inherited = (F.col("branch") == MAIN) & (F.col("branch") != branch) & (F.col("seq") <= start)
    # The first filter says nothing new, but it alone can skip folders of a log stored by branch.
    return changes.where(F.col("branch").isin(branch, MAIN)).where(own | inherited)


def read_branch(base: DataFrame, refs: DataFrame, changes: DataFrame, branch: str = MAIN, *,
                key: str, values: list[str]) -> DataFrame:
    """Rows of a live branch; no rows for a branch that does not exist or was dropped.

    Per key only the last delete and the last update matter: a row stays unless a delete came after
    its birth, and takes the values of the last update after its birth. Copies of a row are kept.

    The deletes and updates of the branch are grouped by key and joined without a hint: adaptive execution
    broadcasts them while their measured size allows, so that the base is not shuffled, and splits the
    tasks of keys that hold many rows where not.
    """
    seen = visible_changes(refs, changes, branch)
    log = seen.where((F.col("op") != "insert") & F.col(key).isNotNull())
    births = (base.where(created_at(refs, branch).isNotNull())
              .select(key, *values, F.lit(0).cast("bigint").alias("__born"))
              .unionByName(seen.where(F.col("op") == "insert")
                           .select(key, *values, F.col("seq").cast("bigint").alias("__born"))))
    update_seq = F.when(F.col("op") == "update", F.col("seq"))
    last = log.groupBy(key).agg(
        F.max(F.when(F.col("op") == "delete", F.col("seq"))).alias("__deleted"), F.max(update_seq).alias("__updated"),
        *[F.max_by(name, update_seq).alias(f"__new_{name}") for name in values])
    joined = births.join(last, key, "left")
    alive = joined.where(F.col("__deleted").isNull() | (F.col("__deleted") < F.col("__born")))
    changed = F.col("__updated") > F.col("__born")
    return alive.select(key, *[
        F.when(changed, F.col(f"__new_{name}")).otherwise(F.col(name)).alias(name) for name in values])


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``surplus`` = copies on the left minus the right.

    Copies are added up before the shuffle, so one row with very many copies moves as one.
    """
    columns = left.columns
    both = (left.withColumn("surplus", F.lit(1).cast("bigint"))
            .unionByName(right.withColumn("surplus", F.lit(-1).cast("bigint"))))
    return both.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).where(F.col("surplus") != 0)
