"""The provided tables in the shape the operators expect."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream import fixed_values as fixed
from tallystream.functions.numeric import pick
from tallystream.functions.text import short_id
from tallystream.functions.times import epoch_offset
from tallystream.operators import branches, catalogue, changes
from tallystream.sources.schemas import schema_of
from tallystream.sources.tables import read_table
from tallystream.streaming.ingest import StreamTable

EVENT_SCHEMA = schema_of({
    "event_id": "bigint", "user_id": "bigint", "vehicle_id": "string", "timestamp": "timestamp",
    "speed_kmh": "double", "lidar_anomaly_flag": "boolean", fixed.PLATOON: "string"})
EVENT_ORDER = ["timestamp", "event_id"]


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Events as vehicle readings; the event type takes the place of the platoon."""
    return read_table(spark, folder, "events").select(
        "event_id", "user_id", short_id(F.col("user_id")).alias("vehicle_id"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("speed_kmh"),
        (F.col("event_type") == "error").alias("lidar_anomaly_flag"),
        F.col("event_type").alias(fixed.PLATOON))


def event_table(root: str) -> StreamTable:
    return StreamTable(root, EVENT_SCHEMA, fixed.PLATOON)


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the provided tables hold them."""
    return df.select([F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
                      for name, kind in df.dtypes])


def violations(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as violation records: the date and the kinds follow from keys, fine and flag from the price."""
    offset = F.pmod(F.col("o_orderkey") * 7919, F.lit(fixed.PERIOD_SECONDS))
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ticket_id"), epoch_offset(fixed.PERIOD_START, offset).alias("violation_date"),
        pick(fixed.VIOLATION_TYPES, F.pmod("o_custkey", F.lit(len(fixed.VIOLATION_TYPES))) + 1).alias("violation_type"),
        pick(fixed.LOCATIONS, F.pmod("o_orderkey", F.lit(len(fixed.LOCATIONS))) + 1).alias("location"),
        F.col("o_totalprice").cast("int").alias("fine_amount"), (F.col("o_totalprice") > 250000).alias("radar_captured"))


TWO_SALARIES = "('Noor', 4100), ('Ilse', 5200)"
TWO_TYPED_ROWS = [(-1, "a row written out"), (-2, "and another")]
SALARIES = schema_of({"name": "string", "salary": "int"})


def customer_salaries(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as (name, salary, segment); those in debt have no name, to have null keys."""
    return read_table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
        F.col("c_acctbal").cast("int").alias("salary"), F.col("c_mktsegment").alias("segment"))


def supplier_salaries(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_name").alias("name"), F.col("s_acctbal").cast("int").alias("salary"))


def branch_refs(spark: SparkSession) -> DataFrame:
    """Main; an experiment, made twice; a branch that was dropped; one that was dropped and made again."""
    nothing = spark.sql("SELECT '' AS branch, 0L AS created_seq, CAST(NULL AS BIGINT) AS dropped_seq").where(F.lit(False))
    refs = nothing
    for branch, seq in [(branches.MAIN, 0), ("experiment", 2), ("experiment", 5), ("abandoned", 2), ("again", 2)]:
        refs = branches.create_branch(refs, branch, seq)
    refs = branches.drop_branch(branches.drop_branch(refs, "abandoned", 9), "again", 7)
    return branches.create_branch(refs, "again", 8)


def branch_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The statements of a history over all customers and suppliers: changes on main before and after the
    branches are made, and on each branch deletes, inserts, updates and re-inserts of deleted names."""
    staff, firms, salary = customer_salaries(spark, folder), supplier_salaries(spark, folder), F.col("salary")

    def of(segment: str) -> DataFrame:
        return staff.where(F.col("segment") == segment)

    def raised(rows: DataFrame, value: Column) -> DataFrame:
        return rows.withColumn("salary", value.cast("int"))

    statements = [
        (branches.MAIN, 1, "update", raised(of("MACHINERY"), salary + 1)),
        ("experiment", 3, "delete", of("BUILDING")),
        ("experiment", 4, "insert", firms),
        (branches.MAIN, 6, "delete", of("FURNITURE")),
        ("experiment", 7, "insert", raised(of("BUILDING").where(salary > 5000), salary * 2)),
        ("experiment", 8, "update", raised(of("AUTOMOBILE"), F.lit(0))),
        ("experiment", 9, "delete", firms.where(salary < 1000)),
        ("abandoned", 4, "delete", of("HOUSEHOLD")),
        ("again", 4, "delete", of("HOUSEHOLD")),
        ("again", 9, "update", raised(of("BUILDING"), salary + 7)),
    ]
    logs = [branches.record(rows, op, seq, branch, key="name", values=["salary"]) for branch, seq, op, rows in statements]
    return reduce(DataFrame.unionByName, logs)


def main_by_hand(spark: SparkSession, folder: str) -> DataFrame:
    """Main after its own two statements, made by an update and a delete of the table itself."""
    staff, named = customer_salaries(spark, folder), F.col("name").isNotNull()
    raised = changes.update_where(staff, named & (F.col("segment") == "MACHINERY"), {"salary": F.col("salary") + 1})
    return changes.delete_where(raised, named & (F.col("segment") == "FURNITURE")).select("name", "salary")


DOCUMENT_TARGET = 8000


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a listing of files: a part for each source, and a document's characters as its size."""
    return read_table(spark, folder, "documents").select(
        F.concat(F.lit("files/"), F.col("doc_id")).alias("path"), F.col("source").alias("part"), F.col("n_chars").alias("bytes"))


def catalogue_tables(spark: SparkSession, folder: str) -> list[tuple[catalogue.Table, DataFrame]]:
    """Suppliers and orders, each with its own columns and key, and their rows on main."""
    orders = read_table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    tables = [("supplier", read_table(spark, folder, "supplier"), ["s_suppkey", "s_name", "s_acctbal"]),
              ("orders", orders, ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])]
    return [(catalogue.Table(name, rows.select(columns).schema, columns[0]), rows.select(columns)) for name, rows, columns in tables]


def catalogue_refs(spark: SparkSession) -> DataFrame:
    nothing = spark.sql("SELECT '' AS branch, 0L AS created_seq, CAST(NULL AS BIGINT) AS dropped_seq").where(F.lit(False))
    return branches.create_branch(branches.create_branch(nothing, branches.MAIN, 0), "trial", 2)


def catalogue_log(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of both tables in one order: on main before the branch, on the branch, and on main afterwards."""
    (firms, suppliers), (sales, orders) = catalogue_tables(spark, folder)
    key = F.col("s_suppkey")
    statements = [
        (branches.MAIN, 1, "update", sales, orders.where(F.col("o_orderkey") % 5 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1)),
        (branches.MAIN, 2, "delete", firms, suppliers.where(key % 11 == 0)),
        ("trial", 3, "delete", sales, orders.where(F.col("o_orderstatus") == "F")),
        ("trial", 4, "insert", firms, suppliers.where(key % 3 == 0).withColumn("s_suppkey", key + 1_000_000)),
        ("trial", 5, "update", firms, suppliers.where(key % 2 == 0).withColumn("s_acctbal", F.col("s_acctbal") * 2)),
        ("trial", 6, "insert", sales, orders.where(F.col("o_orderkey") % 10 == 1).withColumn("o_orderdate", F.lit(None).cast("date"))),
        (branches.MAIN, 7, "delete", sales, orders.where(F.col("o_orderkey") % 2 == 0)),
        (branches.MAIN, 8, "update", firms, suppliers.withColumn("s_name", F.lit("renamed"))),
    ]
    logs = [catalogue.record(rows, table, op, seq, branch) for branch, seq, op, table, rows in statements]
    return reduce(DataFrame.unionByName, logs)


# SQL that both engines read the same way; chr() stands for characters they quote differently.
_T = fixed.TABLE
_NL, _TAB, _CR, _Q, _DQ = "chr(10)", "chr(9)", "chr(13)", "chr(39)", "chr(34)"
_SQL_FENCE, _FENCE = (f"'{fence}'" for fence in fixed.FENCES)
REQUEST_ID_SQL = "conv_id * 1000000 + turn"
REQUEST_TEXT_SQL = f"""
CASE (conv_id + turn) % 9
WHEN 0 THEN {_SQL_FENCE} || {_NL} || 'SELECT COUNT(*) FROM {_T};' || {_NL} || text || {_NL} || {_FENCE}
WHEN 1 THEN 'CALL {fixed.SYSTEM_PREFIX}' || role || '_sweep(' || {_Q} || text || {_Q} || ')'
WHEN 2 THEN 'CALL {fixed.SYSTEM_PREFIX}{fixed.ALLOWED_PROCEDURE}(' || {_Q} || '{_T}' || {_Q} || '); ' || text
WHEN 3 THEN 'CREATE BRANCH IF NOT EXISTS ' || role || ' IN {_T};' || {_NL} || 'USE REFERENCE b IN {_T} FROM main; ' || text
WHEN 4 THEN 'ALTER TABLE {_T} CREATE BRANCH ' || role || {_CR} || {_NL} || text || ';' || {_TAB}
WHEN 5 THEN 'SHOW PARTITIONS ' || {_Q} || '{_T}' || {_Q} || '; SHOW PARTITIONS ' || {_DQ} || '{_T}' || {_DQ}
  || '; show partitions ' || {_DQ} || '{_T}' || {_DQ} || ';' || text
WHEN 6 THEN {_FENCE} || ' ; ;' || text || {_NL} || {_FENCE}
WHEN 7 THEN 'CALL ' || upper('{fixed.SYSTEM_PREFIX}') || 'rollback(' || {_Q} || 't' || {_Q} || '); SELECT '
  || {_Q} || text || ';' || {_Q}
ELSE '-- ' || role || {_NL} || 'DROP TABLE {_T}; ' || {_TAB} || text
END
"""


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """A statement text for every turn of every conversation, each with the turn's whole text."""
    return read_table(spark, folder, "conversations").selectExpr(
        f"{REQUEST_ID_SQL} AS request_id", f"{REQUEST_TEXT_SQL} AS text")


def page_requests(spark: SparkSession, folder: str) -> DataFrame:
    """The whole source of every page as a text to take apart: it is full of semicolons."""
    return read_table(spark, folder, "pages").select(F.col("page_id").alias("request_id"), F.col("html").alias("text"))
