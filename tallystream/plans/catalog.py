"""The registered queries: each takes a session and a folder of tables, and reads them whole."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystream import fixed_values as fixed
from tallystream.functions import numeric, text, times
from tallystream.operators import balance, branches, catalogue, changes, maintenance, reports, statements, writes
from tallystream.plans import inputs
from tallystream.session import prepare, scratch
from tallystream.sources import paths
from tallystream.sources.landing import export_lines
from tallystream.sources.schemas import schema_of
from tallystream.sources.tables import conform, constant_rows, key_range, read_table
from tallystream.streaming import ingest, quarantine

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(prepare(spark), folder)

    QUERIES[query.__name__] = run
    return query


SCRATCH_DATABASE = "tallystream_scratch"


def table_name(spark: SparkSession, label: str) -> str:
    """A table name that no other call gets, in the database that ``drop_scratch_tables`` drops."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE}")
    return f"{SCRATCH_DATABASE}.{label}_{uuid.uuid4().hex}"


def drop_scratch_tables(spark: SparkSession) -> None:
    """Take the tables that queries made out of the catalogue, once their results are not needed any more.

    Their rows lie in the shared folder and go with its clean-up.
    """
    spark.sql(f"DROP DATABASE IF EXISTS {SCRATCH_DATABASE} CASCADE")


# Scans and sources


@register
def range_source(spark: SparkSession, folder: str) -> DataFrame:
    """Every number in the order key domain, with the price of the order that has it.

    Orders are taken as they are, those without a key too; only their distinct keys are shuffled, to find the numbers
    without an order, so a key that very many rows share does not gather in one task.
    """
    orders = read_table(spark, folder, "orders")
    numbers = key_range(spark, orders, "o_orderkey")
    used = orders.select(F.col("o_orderkey").alias("id")).distinct()
    recorded = orders.select(F.col("o_orderkey").alias("ticket_id"), F.col("o_totalprice").alias("price"),
                             F.lit(True).alias("recorded"))
    unused = numbers.join(used, "id", "left_anti").select(
        F.col("id").alias("ticket_id"), F.lit(None).cast("double").alias("price"), F.lit(False).alias("recorded"))
    return recorded.unionByName(unused)


@register
def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select("*")


@register
def typed_rows_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with required columns, written out and from a table, created and then replaced under one name."""
    schema = schema_of({"id": "int", "data": "string"}, required=True)
    rows = conform(read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("data")), schema)
    both = constant_rows(spark, inputs.TWO_TYPED_ROWS, schema).unionByName(rows)
    name = table_name(spark, "typed_rows")
    for _ in range(2):
        writes.create_or_replace(both, name, location=scratch(spark, "typed-rows"))
    return spark.table(name)


# Table writes


@register
def create_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """A second conditional create leaves the table and its rows alone."""
    name, path = table_name(spark, "salaries"), scratch(spark, "salaries")
    writes.create_if_absent(spark, name, inputs.SALARIES, location=path)
    writes.append(inputs.customer_salaries(spark, folder).select("name", "salary"), name)
    writes.create_if_absent(spark, name, inputs.SALARIES, location=path)
    return spark.table(name)


@register
def partitioned_write(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.telemetry(spark, folder)
    return inputs.plain_times(writes.new_folder(rows, scratch(spark, "telemetry"), [fixed.PLATOON]))


@register
def ctas_strict(spark: SparkSession, folder: str) -> DataFrame:
    """A create from a query is refused when the table is there, and the table keeps its rows."""
    name = table_name(spark, "violations")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writes.create_from(orders, name, location=scratch(spark, "violations"))
    try:
        writes.create_from(orders.limit(0), name, location=scratch(spark, "violations"))
    except AnalysisException:
        return spark.table(name)
    raise AssertionError("the second create was not refused")


@register
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a table replaced by others made from them, the table being read meanwhile."""
    name = table_name(spark, "violations")
    writes.full_refresh(inputs.violations(spark, folder), name, location=scratch(spark, "violations"))
    again = spark.table(name).withColumn("fine_amount", F.col("fine_amount") + 1)
    writes.full_refresh(again, name, location=scratch(spark, "violations"))
    return inputs.plain_times(spark.table(name))


@register
def violations_report(spark: SparkSession, folder: str) -> DataFrame:
    """Violation records written as a table, and their revenue by type."""
    name = table_name(spark, "violations")
    writes.full_refresh(inputs.violations(spark, folder), name, location=scratch(spark, "violations"))
    return reports.revenue_by_type(spark.table(name), "violation_type", "fine_amount")


@register
def insert_append(spark: SparkSession, folder: str) -> DataFrame:
    """Rows appended twice are there twice, rows of a query and rows written out alike."""
    name = table_name(spark, "salaries")
    writes.create_if_absent(spark, name, inputs.SALARIES, location=scratch(spark, "salaries"))
    writes.append(inputs.customer_salaries(spark, folder).select("name", "salary"), name)
    suppliers = inputs.supplier_salaries(spark, folder).select("name", "salary")
    for _ in range(2):
        writes.append(suppliers, name)
        spark.sql(f"INSERT INTO {name} VALUES {inputs.TWO_SALARIES}")
    return spark.table(name)


@register
def bounded_preview(spark: SparkSession, folder: str) -> DataFrame:
    return reports.preview(read_table(spark, folder, "conversations"), "conv_id", "turn")


@register
def longer_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The preview of twenty rows that is shown unless a number is given."""
    return reports.preview(read_table(spark, folder, "conversations"), "conv_id", "turn", rows=fixed.SHOWN_ROWS)


@register
def shown_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The drawn table that a preview of ten rows shows."""
    return reports.shown_text(read_table(spark, folder, "conversations"), "conv_id", "turn")


# Projections and scalar functions


@register
def derived_projection(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").selectExpr(
        "o_orderkey AS ticket_id",
        "CAST(o_totalprice AS INT) AS fine_amount",
        "CAST(-o_totalprice AS INT) AS refund",
        "CAST(o_totalprice / 1000 * 250 + 50 AS INT) AS scaled",
        "o_custkey + CAST(o_totalprice AS INT) AS mixed",
        "o_totalprice > 250000 AS radar_captured")


@register
def epoch_offset_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    """A moment in the year per order, as number, text and timestamp."""
    offset = F.pmod(F.col("o_orderkey") * 7919, F.lit(fixed.PERIOD_SECONDS))
    seconds = times.epoch_offset_seconds(fixed.PERIOD_START, offset)
    moment = times.epoch_offset(fixed.PERIOD_START, offset)
    return inputs.plain_times(read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ticket_id"), seconds.alias("epoch"),
        F.from_unixtime(seconds).alias("text"), F.from_unixtime(seconds).cast("timestamp").alias("parsed"),
        moment.alias("violation_date")))


@register
def category_pick(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as violation records: kinds and places picked from lists by position."""
    return inputs.plain_times(inputs.violations(spark, folder))


@register
def clamp_round(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        "event_id", numeric.clamp(F.col("value"), fixed.SPEED_MIN, fixed.SPEED_MAX).alias("bounded"),
        numeric.bounded_reading(F.col("value") / 7, fixed.SPEED_MIN, 20.0).alias("reading"))


@register
def vehicle_key(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        "event_id", text.short_id(F.col("user_id")).alias("vehicle_id"),
        F.concat(F.lit("telemetry_"), times.whole_second(F.col("ts")), F.lit(".json")).alias("file_name"))


@register
def tick_bucket(spark: SparkSession, folder: str) -> DataFrame:
    """Readings per interval of ten seconds and event type."""
    return (read_table(spark, folder, "events").groupBy(times.tick(F.col("ts")).alias("tick"), "event_type")
            .agg(F.count(F.lit(1)).alias("readings")))


@register
def json_props(spark: SparkSession, folder: str) -> DataFrame:
    """Typed field of a JSON text, and the row written as JSON text again."""
    parsed = F.from_json("props", "k int").alias("parsed")
    return (read_table(spark, folder, "events").select("event_id", parsed, "event_type")
            .select("event_id", F.col("parsed.k").alias("k"),
                    F.to_json(F.struct("event_id", "event_type", "parsed.k")).alias("line")))


# Aggregates, sorts and limits


@register
def revenue_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return reports.revenue_by_type(read_table(spark, folder, "lineitem"), "l_returnflag", "l_linenumber")


@register
def global_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.row_count(read_table(spark, folder, "lineitem"))


@register
def sample_topk(spark: SparkSession, folder: str) -> DataFrame:
    return reports.first_rows(read_table(spark, folder, "orders"), "o_orderkey")


# Row changes


@register
def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without those of one segment above a salary; where either is unknown the row stays."""
    rows = inputs.customer_salaries(spark, folder)
    gone = (F.col("segment") == "BUILDING") & (F.col("name") > "Customer#000000100")
    kept = changes.delete_where(rows, gone)
    return writes.new_folder(kept, scratch(spark, "salaries"))


@register
def delete_in_place(spark: SparkSession, folder: str) -> DataFrame:
    """Orders stored by status, without the cheap ones of one status: only its partition is written anew."""
    name = table_name(spark, "orders")
    writes.create_or_replace(read_table(spark, folder, "orders"), name, partition_by=["o_orderstatus"], location=scratch(spark, "orders"))
    changes.delete_in_place(spark, name, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 200000), "o_orderstatus")
    return spark.table(name)


@register
def update_in_place(spark: SparkSession, folder: str) -> DataFrame:
    """Orders stored by status, with the price of one customer's changed in the partitions that have such orders."""
    name = table_name(spark, "orders")
    writes.create_or_replace(read_table(spark, folder, "orders"), name, partition_by=["o_orderstatus"], location=scratch(spark, "orders"))
    changes.update_in_place(spark, name, F.col("o_custkey") % 7 == 3, "o_orderstatus", {"o_totalprice": F.col("o_totalprice") * 2})
    return spark.table(name)


@register
def update_where(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.customer_salaries(spark, folder)
    condition = (F.col("segment") == "AUTOMOBILE") & F.col("name").startswith("Customer#")
    return changes.update_where(rows, condition, {"salary": F.col("salary") / 2 + 100, "segment": F.lit("RAISED")})


# Branches


def _history(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Base, refs and log; the log is a table stored by branch, as it is where branches are used."""
    base = inputs.customer_salaries(spark, folder).select("name", "salary")
    log = writes.new_folder(inputs.branch_changes(spark, folder), scratch(spark, "changes"), ["branch"])
    return base, inputs.branch_refs(spark), log


_COLUMNS = {"key": "name", "values": ["salary"]}


@register
def branch_state(spark: SparkSession, folder: str) -> DataFrame:
    """The experiment branch: main as it was, with the deletes, inserts and updates made on it."""
    return branches.read_branch(*_history(spark, folder), "experiment", **_COLUMNS)


@register
def branch_isolation(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of main that differ from main made by hand without any branch, and rows the experiment differs in.

    Each of the three states is resolved once and counted in one grouping.
    """
    history = _history(spark, folder)
    states = {"main": branches.read_branch(*history, **_COLUMNS), "plain": inputs.main_by_hand(spark, folder),
              "experiment": branches.read_branch(*history, "experiment", **_COLUMNS)}
    tagged = [rows.select("name", "salary", *[F.lit(int(state == other)).alias(other) for other in states])
              for state, rows in states.items()]
    copies = reduce(DataFrame.unionByName, tagged).groupBy("name", "salary").agg(
        *[F.sum(state).alias(state) for state in states])

    def surplus(left: str, right: str) -> Column:
        return F.coalesce(F.sum(F.greatest(F.col(left) - F.col(right), F.lit(0))), F.lit(0)).cast("bigint")

    found = copies.agg(F.array(*[
        F.struct(F.lit(compared).alias("compared"), surplus(left, right).alias("added"), surplus(right, left).alias("missing"))
        for compared, left, right in [("main", "main", "plain"), ("experiment", "experiment", "main")]]).alias("found"))
    return found.select(F.explode("found").alias("f")).select("f.*")


@register
def branch_drop(spark: SparkSession, folder: str) -> DataFrame:
    """A dropped branch has no rows; one that was dropped and made again starts clean."""
    history = _history(spark, folder)
    dropped, again = (branches.read_branch(*history, name, **_COLUMNS).withColumn("branch", F.lit(name))
                      for name in ("abandoned", "again"))
    return dropped.unionByName(again)


@register
def catalogue_branch(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables of different columns as one branch has them, and as main has them, from one log and one list of refs."""
    log = writes.new_folder(inputs.catalogue_log(spark, folder), scratch(spark, "log"), ["branch"])
    states = []
    for branch in ("trial", branches.MAIN):
        firms, orders = (catalogue.read_table(base, inputs.catalogue_refs(spark), log, table, branch)
                         for table, base in inputs.catalogue_tables(spark, folder))
        states += [
            firms.select(F.lit(branch).alias("branch"), F.lit("supplier").alias("tab"), F.col("s_suppkey").alias("id"),
                         F.col("s_name").alias("label"), F.col("s_acctbal").alias("amount"), F.lit(None).cast("date").alias("day")),
            orders.select(F.lit(branch), F.lit("orders"), "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")]
    return reduce(DataFrame.unionAll, states)


# Statement texts


@register
def statement_clean(spark: SparkSession, folder: str) -> DataFrame:
    return statements.clean(inputs.requests(spark, folder))


@register
def statement_split(spark: SparkSession, folder: str) -> DataFrame:
    return statements.split(inputs.page_requests(spark, folder))


@register
def statement_guard(spark: SparkSession, folder: str) -> DataFrame:
    return statements.guard(inputs.requests(spark, folder))


@register
def guard_outcome(spark: SparkSession, folder: str) -> DataFrame:
    return statements.outcome(inputs.requests(spark, folder))


# Streams and the tables they fill

_FILES = 8


def _land(rows: DataFrame, landing: str, files: int = _FILES // 2) -> None:
    export_lines(rows, landing, inputs.EVENT_ORDER, files=files, mode="append")


def _streamed(spark: SparkSession, folder: str, batches: int = 2) -> ingest.StreamTable:
    """All events exported to a landing folder and taken in by a stream of several batches."""
    root = scratch(spark, "stream")
    table = inputs.event_table(root)
    _land(inputs.telemetry(spark, folder), f"{root}/landing", _FILES)
    ingest.ingest_available(spark, f"{root}/landing", table, math.ceil(_FILES / batches))
    return table


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-16 00:00:00")))
    early = F.col("timestamp") < cut
    return rows.where(early), rows.where(~F.coalesce(early, F.lit(False)))


@register
def landing_export(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON lines with their ticks of ten seconds, in one folder per day, read back with tick and day."""
    path = scratch(spark, "landing")
    export_lines(inputs.telemetry(spark, folder), path, inputs.EVENT_ORDER, tick_of="timestamp", folder_seconds=86400)
    schema = StructType([*inputs.EVENT_SCHEMA, *schema_of({"tick": "bigint", "first_tick": "bigint"})])
    return inputs.plain_times(spark.read.schema(schema).option("timeZone", "UTC").json(path))


@register
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.plain_times(ingest.read_snapshot(spark, _streamed(spark, folder)))


@register
def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """The stream stops, more files arrive, it starts again from its checkpoint, twice."""
    root = scratch(spark, "stream")
    table, landing = inputs.event_table(root), f"{root}/landing"
    for part in _halves(inputs.telemetry(spark, folder)):
        _land(part, landing)
        ingest.ingest_available(spark, landing, table)
    ingest.ingest_available(spark, landing, table)
    return inputs.plain_times(ingest.read_snapshot(spark, table))


def _spoilt_stream(spark: SparkSession, folder: str) -> ingest.StreamTable:
    """All events streamed: lines of errors arrive cut off and those of purchases with a text for the speed."""
    root = scratch(spark, "stream")
    table, landing = inputs.event_table(root), f"{root}/landing"
    line = F.to_json(F.struct("event_id", "user_id", "vehicle_id", times.iso_text(F.col("timestamp")).alias("timestamp"),
                              "speed_kmh", "lidar_anomaly_flag", fixed.PLATOON))
    spoilt = (F.when(F.col(fixed.PLATOON) == "error", F.concat(F.lit('{"event_id":'), "event_id"))
              .when(F.col(fixed.PLATOON) == "purchase",
                    F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"speed_kmh":"x"}')))
              .otherwise(line))
    inputs.telemetry(spark, folder).select(spoilt.alias("value")).write.text(landing)
    ingest.ingest_available(spark, landing, table)
    return table


@register
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Lines taken in and lines set aside, these by the field that does not fit, with what its other fields hold."""
    table = _spoilt_stream(spark, folder)
    good = ingest.read_snapshot(spark, table).select(
        F.lit("good").alias("verdict"), F.col(fixed.PLATOON).alias("event_type"), F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("bigint").alias("chars"), F.lit(None).cast("bigint").alias("event_id"))
    bad = quarantine.explain(ingest.read_quarantine(spark, table), table.schema).select(
        F.lit("bad").alias("verdict"), F.col(f"kept.{fixed.PLATOON}").alias("event_type"), "reason",
        F.length("line").cast("bigint").alias("chars"), F.col("kept.event_id").alias("event_id"))
    return good.unionByName(bad).groupBy("verdict", "event_type", "reason").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("chars").alias("chars"), F.sum("event_id").alias("kept_ids"))


@register
def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and bad rows as each batch counted them while it was written, beside those that the table holds."""
    table = _spoilt_stream(spark, folder)
    counted = ingest.batch_counts(spark, table).agg(
        F.sum("n_rows").alias("rows_seen"), F.sum("n_bad").alias("bad_seen"))
    held = ingest.read_committed(spark, table).agg(
        F.count(F.lit(1)).alias("rows_held"), F.count_if(F.col("verdict") == ingest.BAD).alias("bad_held"))
    return counted.select(F.lit("seen").alias("what"), F.col("rows_seen").alias("n_rows"), F.col("bad_seen").alias("n_bad")).unionAll(
        held.select(F.lit("held"), "rows_held", "bad_held"))


@register
def late_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that came too late for the stream are found by the ledger and taken in beside it, each once."""
    root = scratch(spark, "stream")
    table, landing, held = inputs.event_table(root), f"{root}/landing", f"{root}/held"
    early, late = _halves(inputs.telemetry(spark, folder))
    _land(late, held)
    _land(early, landing)
    # With an age of nothing all files older than the newest are too late: those held back and delivered now.
    ingest.ingest_available(spark, landing, table, max_file_age="0s")
    paths.move_files(spark, held, landing)
    ingest.ingest_available(spark, landing, table, max_file_age="0s")
    newest = ingest.newest_batch(spark, table)
    for _ in range(2):
        ingest.take_late(spark, landing, table, max_file_age="0s")
    rows = ingest.read_committed(spark, table).where(F.col("verdict") == ingest.GOOD)
    return inputs.plain_times(rows.select(*table.schema.fieldNames(), (F.col("batch_id") > newest).alias("late")))


@register
def snapshot_read(spark: SparkSession, folder: str) -> DataFrame:
    """Readers of an earlier cut do not see the batches that came, or were merged, after it."""
    root = scratch(spark, "stream")
    table, landing = inputs.event_table(root), f"{root}/landing"
    early, late = _halves(inputs.telemetry(spark, folder))
    _land(early, landing)
    ingest.ingest_available(spark, landing, table)
    cut = ingest.newest_batch(spark, table)
    _land(late, landing)
    ingest.ingest_available(spark, landing, table)
    maintenance.compact(spark, table)
    return inputs.plain_times(ingest.read_snapshot(spark, table, upto=cut))


@register
def list_partitions(spark: SparkSession, folder: str) -> DataFrame:
    rows = ingest.read_snapshot(spark, _streamed(spark, folder, batches=1))
    return reports.list_partitions(rows, fixed.PLATOON).withColumnRenamed(fixed.PLATOON, "event_type")


@register
def compact_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows after the files of the stream were merged."""
    table = _streamed(spark, folder)
    maintenance.compact(spark, table)
    return inputs.plain_times(ingest.read_snapshot(spark, table))


@register
def compact_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per partition before and after a merge, the files that hold them after it, and whether these are fewer."""
    table = _streamed(spark, folder)
    before = maintenance.audit_table(spark, table)
    maintenance.compact(spark, table)
    after = maintenance.audit_table(spark, table)
    joined = before.alias("b").join(after.alias("a"), F.col(f"b.{fixed.PLATOON}").eqNullSafe(F.col(f"a.{fixed.PLATOON}")), "full_outer")
    return joined.select(
        F.coalesce(f"b.{fixed.PLATOON}", f"a.{fixed.PLATOON}").alias("event_type"), F.col("b.row_count").alias("rows_before"),
        F.col("a.row_count").alias("rows_after"), F.col("a.file_count").alias("files_after"),
        (F.col("a.file_count") < F.col("b.file_count")).alias("fewer_files"))


@register
def small_file_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Per partition of a freshly streamed table: rows, the files that a merge of its small ones would leave, and whether
    these are fewer; counted from its files without reading a column."""
    audit = maintenance.audit_table(spark, _streamed(spark, folder))
    return audit.select(F.col(fixed.PLATOON).alias("event_type"), "row_count", "small_files_after",
                        (F.col("small_files") > F.col("small_files_after")).alias("merge_helps"))


@register
def merge_bins(spark: SparkSession, folder: str) -> DataFrame:
    """The bins that small files are merged in, over a listing in which every document is a file."""
    return maintenance.bins(inputs.document_files(spark, folder), inputs.DOCUMENT_TARGET)


@register
def merge_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Files, small files and the files that a merge leaves, per part of the same listing."""
    return maintenance.audit(inputs.document_files(spark, folder), inputs.DOCUMENT_TARGET)


@register
def energy_balance(spark: SparkSession, folder: str) -> DataFrame:
    """Battery of each vehicle after each reading; three vehicles in five belong to the first platoon."""
    platoon_a, platoon_b = fixed.START_BALANCE
    in_a = F.pmod("user_id", F.lit(5)) < 3
    start = F.when(in_a, F.lit(fixed.START_BALANCE[platoon_a])).otherwise(F.lit(fixed.START_BALANCE[platoon_b]))
    readings = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    steps = balance.energy_balance(readings, vehicle="user_id", order=["ts", "event_id"], speed="value", start=start)
    return steps.select("event_id", text.short_id(F.col("user_id")).alias("vehicle_id"),
                        F.when(in_a, F.lit(platoon_a)).otherwise(F.lit(platoon_b)).alias("platoon"), "battery_kwh")
