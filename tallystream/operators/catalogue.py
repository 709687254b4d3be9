"""What-if branches over several tables at once.

A branch belongs to the catalogue and not to a table: one list of refs says which branches live, and one log holds the
changes of all tables in one order, so that creating a branch fixes the state of every table, and dropping it drops
the changes to all of them. Rows of different tables have different columns; the log keeps them as a variant, which
holds each value with its type, and gives them their table's columns back when they are read.

``log(branch, seq, op, tab, key, row)``: ``key`` is the row's key as text, ``row`` its columns (null for a delete).
A read names table and branch, and both are filtered before any payload is opened; what follows is the resolution of
one table's branch in ``branches``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystream.operators import branches


@dataclass(frozen=True)
class Table:
    """A table of the catalogue: its name, the columns of its rows, and the one that is the key."""

    name: str
    schema: StructType
    key: str

    def __post_init__(self) -> None:
        if self.key not in self.schema.fieldNames():
            raise ValueError(f"{self.key} is no column of {self.name}")

    @property
    def values(self) -> list[str]:
        return [name for name in self.schema.fieldNames() if name != self.key]


def record(rows: DataFrame, table: Table, operation: str, seq: int, branch: str = branches.MAIN) -> DataFrame:
    """Log entries for one statement on a table: rows to insert, keys to delete, or keys with all their new values."""
    if operation not in branches.OPERATIONS:
        raise ValueError(f"{operation} is none of {branches.OPERATIONS}")
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema] if operation != "delete" else []
    row = F.to_variant_object(F.struct(*fields)) if fields else F.parse_json(F.lit(None).cast("string"))
    return rows.select(
        F.lit(branch).alias("branch"), F.lit(seq).cast("bigint").alias("seq"), F.lit(operation).alias("op"),
        F.lit(table.name).alias("tab"), F.col(table.key).cast("string").alias("key"), row.alias("row"))


def changes_of(log: DataFrame, table: Table, branch: str = branches.MAIN) -> DataFrame:
    """The log's entries for one table, on a branch and on main, with the table's own columns."""
    own = log.where((F.col("tab") == table.name) & F.col("branch").isin(branch, branches.MAIN))
    kind = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in table.schema)
    opened = own.withColumn("r", F.col("row").cast(f"struct<{kind}>"))
    # A delete has no row, so every entry takes its key from the text.
    key = F.col("key").cast(table.schema[table.key].dataType).alias(table.key)
    return opened.select("branch", "seq", "op", key, *[F.col(f"r.`{name}`").alias(name) for name in table.values])


def read_table(base: DataFrame, refs: DataFrame, log: DataFrame, table: Table, branch: str = branches.MAIN) -> DataFrame:
    """Rows of one table as a branch of the catalogue has them; no rows for a branch that does not live."""
    rows = base.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])
    state = branches.read_branch(rows, refs, changes_of(log, table, branch), branch, key=table.key, values=table.values)
    return state.select(table.schema.fieldNames())
