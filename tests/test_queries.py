"""Every registered query against its SQL twin, values and types."""

import pytest

import __spark_entry__ as entry_points
from comparing import TYPE_NAMES, canonical, oracle_rows
from conftest import SF_DIR
from tallystream.plans.catalog import QUERIES, SCRATCH_DATABASE, drop_scratch_tables
from tallystream.plans.oracles import ORACLES



def test_each_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


def test_scratch_tables_are_dropped(spark):
    rows = QUERIES["insert_append"](spark, SF_DIR)
    assert rows.count() and spark.catalog.listTables(SCRATCH_DATABASE)
    drop_scratch_tables(spark)
    assert not spark.catalog.databaseExists(SCRATCH_DATABASE)


def test_every_text_is_in_its_request(spark):
    from tallystream.plans import inputs
    texts = spark.read.parquet(f"{SF_DIR}/conversations.parquet").selectExpr(f"{inputs.REQUEST_ID_SQL} AS request_id", "text AS own")
    both = inputs.requests(spark, SF_DIR).join(texts, "request_id")
    assert both.count() == texts.count() and both.where("NOT contains(text, own)").isEmpty()


def test_no_row_is_lost_to_a_null(spark, folder):
    """Events without a time and without a type go through restart, snapshot and report like the others."""
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").limit(300)
    rows.selectExpr("event_id", "user_id", "IF(event_id % 10 = 0, NULL, ts) AS ts", "IF(event_id % 7 = 0, NULL, event_type) AS event_type",
                    "value", "props").write.parquet(f"{folder}/events.parquet")
    kept = spark.read.parquet(f"{folder}/events.parquet")
    missing = kept.where("event_type IS NULL").count()
    assert missing and QUERIES["stream_restart"](spark, folder).count() == kept.count()
    report = {r.event_type: (r.rows_before, r.rows_after) for r in QUERIES["compact_report"](spark, folder).collect()}
    assert report[None] == (missing, missing) and sum(a for a, _ in report.values()) == kept.count()


def events_with_a_lone_type(spark, folder):
    """400 events of two types, which all files of the stream hold, and one event of a third, which one file holds."""
    spark.range(401).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS ts",
        "CASE WHEN id = 400 THEN 'lone' WHEN id % 2 = 0 THEN 'even' ELSE 'odd' END AS event_type", "id * 0.5D AS value",
        "'{}' AS props").write.parquet(f"{folder}/events.parquet")
    return folder


def test_the_report_counts_the_files_after_a_merge(spark, folder):
    rows = QUERIES["compact_report"](spark, events_with_a_lone_type(spark, folder)).collect()
    report = {r.event_type: (r.rows_before, r.rows_after, r.files_after, r.fewer_files) for r in rows}
    assert report == {"even": (200, 200, 1, True), "odd": (200, 200, 1, True), "lone": (1, 1, 1, False)}


def test_the_audit_tells_what_a_merge_leaves(spark, folder):
    rows = QUERIES["small_file_audit"](spark, events_with_a_lone_type(spark, folder)).collect()
    audit = {r.event_type: (r.row_count, r.small_files_after, r.merge_helps) for r in rows}
    assert audit == {"even": (200, 1, True), "odd": (200, 1, True), "lone": (1, 1, False)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_twin(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    names, types, expected = oracle_rows(SF_DIR, ORACLES[name])
    assert sorted(result.columns) == sorted(names)
    actual = canonical(result.columns, [tuple(row) for row in result.collect()])
    wanted = canonical(names, expected)
    assert sum(actual.values()) == sum(wanted.values())
    assert actual == wanted, f"{list((actual - wanted).items())[:3]} instead of {list((wanted - actual).items())[:3]}"
    assert {n: TYPE_NAMES[t] for n, t in result.dtypes} == types


def test_ordered_results_keep_their_order(spark):
    totals = [row.total_revenue for row in QUERIES["revenue_by_type"](spark, SF_DIR).collect()]
    assert totals == sorted(totals, reverse=True)


def test_flagship_runs(spark):
    assert entry_points.entry(spark).count() == 3
