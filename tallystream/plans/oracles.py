"""For each registered query, SQL over the same tables that gives the same rows."""

from __future__ import annotations

from tallystream import fixed_values as fixed
from tallystream.plans import inputs


def _texts(values: list[str]) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_VEHICLE = f"'{fixed.VEHICLE_PREFIX}' || substr(md5(CAST(user_id AS VARCHAR)), 1, {fixed.VEHICLE_DIGITS})"
_TELEMETRY = f"""
SELECT event_id, user_id, {_VEHICLE} AS vehicle_id, ts AS "timestamp", value AS speed_kmh,
       event_type = 'error' AS lidar_anomaly_flag, event_type AS cooperative_platoon_id
FROM events"""

_SALARIES = """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
       CAST(trunc(c_acctbal) AS INTEGER) AS salary, c_mktsegment AS segment
FROM customer"""
_SUPPLIERS = "SELECT s_suppkey, s_name AS name, CAST(trunc(s_acctbal) AS INTEGER) AS salary FROM supplier"


def _violations(extra: int = 0) -> str:
    return f"""
SELECT o_orderkey AS ticket_id,
       TIMESTAMP '{fixed.PERIOD_START}' + to_seconds((o_orderkey * 7919) % {fixed.PERIOD_SECONDS}) AS violation_date,
       {_texts(fixed.VIOLATION_TYPES)}[o_custkey % 5 + 1] AS violation_type,
       {_texts(fixed.LOCATIONS)}[o_orderkey % 5 + 1] AS location,
       CAST(trunc(o_totalprice) AS INTEGER) + {extra} AS fine_amount, o_totalprice > 250000 AS radar_captured
FROM orders"""


def _number(value: int | None) -> str:
    return "NULL" if value is None else str(value)


_REF_ROWS = [("main", 0, None), ("experiment", 2, None), ("experiment", 5, None),
             ("abandoned", 2, 9), ("again", 2, 7), ("again", 8, None)]
_REFS = "SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', CAST({created} AS BIGINT), CAST({_number(dropped)} AS BIGINT))"
    for name, created, dropped in _REF_ROWS) + ") AS r(branch, created_seq, dropped_seq)"


def _step(table: str, branch: str, number: int, op: str, value: str, where: str = "true") -> str:
    return (f"SELECT '{branch}' AS branch, {number} AS seq, '{op}' AS op, name, "
            f"CAST({value} AS INTEGER) AS salary FROM {table} WHERE {where}")


_CHANGES = "\nUNION ALL ".join([
    _step("staff", "main", 1, "update", "salary + 1", "segment = 'MACHINERY'"),
    _step("staff", "experiment", 3, "delete", "NULL", "segment = 'BUILDING'"),
    _step("firms", "experiment", 4, "insert", "salary"),
    _step("staff", "main", 6, "delete", "NULL", "segment = 'FURNITURE'"),
    _step("staff", "experiment", 7, "insert", "salary * 2", "segment = 'BUILDING' AND salary > 5000"),
    _step("staff", "experiment", 8, "update", "0", "segment = 'AUTOMOBILE'"),
    _step("firms", "experiment", 9, "delete", "NULL", "salary < 1000"),
    _step("staff", "abandoned", 4, "delete", "NULL", "segment = 'HOUSEHOLD'"),
    _step("staff", "again", 4, "delete", "NULL", "segment = 'HOUSEHOLD'"),
    _step("staff", "again", 9, "update", "salary + 7", "segment = 'BUILDING'"),
])
_HISTORY = f"staff AS ({_SALARIES}),\nfirms AS ({_SUPPLIERS}),\nrefs AS ({_REFS}),\nchanges AS ({_CHANGES})"


def _state(label: str, branch: str, only: str = "true") -> str:
    """CTEs that end in one called ``label`` with the rows of a branch; ``only`` restricts the log."""
    start = f"(SELECT min(created_seq) FROM refs WHERE branch = '{branch}' AND dropped_seq IS NULL)"
    return f"""
{label}_seen AS (SELECT * FROM changes WHERE {only} AND ((branch = '{branch}' AND seq > {start})
    OR ('{branch}' <> 'main' AND branch = 'main' AND seq <= {start}))),
{label}_rows AS (SELECT name, salary, 0 AS born FROM staff WHERE {start} IS NOT NULL
    UNION ALL SELECT name, salary, seq FROM {label}_seen WHERE op = 'insert'),
{label} AS (SELECT r.name, CASE WHEN n.seq > r.born THEN n.salary ELSE r.salary END AS salary
    FROM {label}_rows r LEFT JOIN (
        SELECT name, seq, salary FROM {label}_seen WHERE op = 'update'
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY seq DESC) = 1) n ON n.name = r.name
    WHERE NOT EXISTS (SELECT 1 FROM {label}_seen d WHERE d.op = 'delete' AND d.name = r.name AND d.seq > r.born))"""


_SPACES = " || ".join(f"chr({ord(char)})" for char in fixed.WHITESPACE)


def _cleaned(text: str) -> str:
    for fence in fixed.FENCES:
        text = f"replace({text}, {_quoted(fence)}, '')"
    text = f"replace(trim({text}, {_SPACES}), chr(10), ' ')"
    for search, replacement in fixed.REWRITES:
        text = f"replace({text}, {_quoted(search)}, {_quoted(replacement)})"
    return text


_REQUESTS = f"SELECT {inputs.REQUEST_ID_SQL} AS request_id, {inputs.REQUEST_TEXT_SQL} AS text FROM conversations"


def _split(requests: str) -> str:
    return f"""
SELECT request_id, pos, statement FROM (
  SELECT request_id, pos, trim(parts[pos + 1], {_SPACES}) AS statement FROM (
    SELECT request_id, parts, unnest(range(len(parts)))::INTEGER AS pos FROM (
      SELECT request_id, string_split({_cleaned('text')}, ';') AS parts FROM ({requests}))))
WHERE statement <> ''"""


_GUARDED = f"""
SELECT request_id, pos, statement,
       CASE WHEN contains(lower(statement), '{fixed.SYSTEM_PREFIX}')
             AND NOT contains(lower(statement), '{fixed.ALLOWED_PROCEDURE}') THEN 'blocked' ELSE 'kept' END AS verdict
FROM ({_split(_REQUESTS)})"""


def _cell(value: str) -> str:
    shown = f"coalesce(CAST({value} AS VARCHAR), 'NULL')"
    for code, escape in [(10, "\\n"), (13, "\\r"), (9, "\\t"), (12, "\\f"), (8, "\\b"), (11, "\\v"), (7, "\\a")]:
        shown = f"replace({shown}, chr({code}), '{escape}')"
    width = fixed.PREVIEW_WIDTH
    return f"CASE WHEN length({shown}) > {width} THEN substr({shown}, 1, {width - 3}) || '...' ELSE {shown} END"


def _preview(rows: int) -> str:
    return f"""
SELECT {', '.join(f'{_cell(c)} AS {c}' for c in ['conv_id', 'turn', 'role', 'text'])}
FROM (SELECT * FROM conversations ORDER BY conv_id, turn LIMIT {rows})"""


_UNITS = (f"CAST(round(greatest({fixed.SPEED_MIN}, least({fixed.SPEED_MAX}, value))"
          f" * {fixed.DRAIN_PER_KMH} * 1000000000) AS BIGINT)")

_SMALL = inputs.DOCUMENT_TARGET * 3 // 4
_BINS = f"""
WITH files AS (SELECT 'files/' || doc_id AS path, source AS part, n_chars AS bytes FROM documents),
placed AS (
  SELECT *, CAST(floor(coalesce(sum(bytes) OVER (
    PARTITION BY part ORDER BY bytes, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {inputs.DOCUMENT_TARGET}) AS BIGINT) AS bin
  FROM files WHERE bytes < {_SMALL}),
kept AS (SELECT * FROM placed QUALIFY count(*) OVER (PARTITION BY part, bin) > 1)"""


def _shown(rows: int, columns: list[str]) -> str:
    """The drawn preview of conversations; its cells are those of ``_preview``."""
    width = {c: f"CAST((SELECT greatest(3, {len(c)}, max(length({c}))) FROM shown) AS INTEGER)" for c in columns}
    rule = " || '+' || ".join(f"repeat('-', {width[c]})" for c in columns)
    head = " || '|' || ".join(f"lpad('{c}', {width[c]}, ' ')" for c in columns)
    body = " || '|' || ".join(f"lpad({c}, {width[c]}, ' ')" for c in columns)
    return f"""
WITH shown AS MATERIALIZED (SELECT *, row_number() OVER () AS n FROM ({_preview(rows)})),
more AS (SELECT count(*) > {rows} AS more FROM conversations),
lines AS (
  SELECT 0 AS k, 0 AS n, '+' || {rule} || '+' AS text UNION ALL SELECT 1, 0, '|' || {head} || '|'
  UNION ALL SELECT 2, 0, '+' || {rule} || '+' UNION ALL SELECT 3, n, '|' || {body} || '|' FROM shown
  UNION ALL SELECT 4, 0, '+' || {rule} || '+' UNION ALL SELECT 5, 0, 'only showing top {rows} rows' FROM more WHERE more)
SELECT CAST(row_number() OVER (ORDER BY k, n) - 1 AS INTEGER) AS line, text FROM lines"""


ORACLES: dict[str, str] = {
    "range_source": """
SELECT coalesce(id, o_orderkey) AS ticket_id, o_totalprice AS price, o_custkey IS NOT NULL AS recorded
FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS id FROM orders)
FULL JOIN orders ON o_orderkey = id""",
    "table_scan": "SELECT * FROM orders",
    "typed_rows_roundtrip": "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS data FROM customer UNION ALL "
                            + " UNION ALL ".join(f"SELECT {id_}, '{data}'" for id_, data in inputs.TWO_TYPED_ROWS),
    "create_if_absent": f"SELECT name, salary FROM ({_SALARIES})",
    "partitioned_write": _TELEMETRY,
    "ctas_strict": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "full_refresh": _violations(extra=1),
    "violations_report": f"""
SELECT violation_type, count(*) AS ticket_amount, CAST(sum(fine_amount) AS BIGINT) AS total_revenue
FROM ({_violations()}) GROUP BY violation_type ORDER BY total_revenue DESC, violation_type""",
    "insert_append": f"""
SELECT name, salary FROM ({_SALARIES})
UNION ALL SELECT name, salary FROM ({_SUPPLIERS}) UNION ALL SELECT name, salary FROM ({_SUPPLIERS})
UNION ALL SELECT * FROM (VALUES {inputs.TWO_SALARIES}, {inputs.TWO_SALARIES})""",
    "bounded_preview": _preview(fixed.PREVIEW_ROWS),
    "longer_preview": _preview(fixed.SHOWN_ROWS),
    "shown_preview": _shown(fixed.PREVIEW_ROWS, ["conv_id", "turn", "role", "text"]),
    "derived_projection": """
SELECT o_orderkey AS ticket_id, CAST(trunc(o_totalprice) AS INTEGER) AS fine_amount,
       CAST(trunc(-o_totalprice) AS INTEGER) AS refund,
       CAST(trunc(o_totalprice / 1000 * 250 + 50) AS INTEGER) AS scaled,
       o_custkey + CAST(trunc(o_totalprice) AS INTEGER) AS mixed,
       o_totalprice > 250000 AS radar_captured
FROM orders""",
    "epoch_offset_timestamp": f"""
SELECT o_orderkey AS ticket_id, CAST(epoch(moment) AS BIGINT) AS epoch,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS text, moment AS parsed, moment AS violation_date
FROM (SELECT o_orderkey, TIMESTAMP '{fixed.PERIOD_START}'
             + to_seconds((o_orderkey * 7919) % {fixed.PERIOD_SECONDS}) AS moment FROM orders)""",
    "category_pick": _violations(),
    "clamp_round": f"""
SELECT event_id, greatest({fixed.SPEED_MIN}, least({fixed.SPEED_MAX}, value)) AS bounded,
       round(greatest({fixed.SPEED_MIN}, least(20.0, value / 7)), 2) AS reading
FROM events""",
    "vehicle_key": f"""
SELECT event_id, {_VEHICLE} AS vehicle_id,
       'telemetry_' || CAST(floor(epoch(ts)) AS BIGINT) || '.json' AS file_name
FROM events""",
    "tick_bucket": f"""
SELECT CAST(floor(epoch(ts) / {fixed.TICK_SECONDS}) * {fixed.TICK_SECONDS} AS BIGINT) AS tick, event_type,
       count(*) AS readings
FROM events GROUP BY 1, 2""",
    "json_props": """
SELECT event_id, k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","k":' || k || '}' AS line
FROM (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "revenue_by_type": """
SELECT l_returnflag AS violation_type, count(*) AS ticket_amount, CAST(sum(l_linenumber) AS BIGINT) AS total_revenue
FROM lineitem GROUP BY l_returnflag ORDER BY total_revenue DESC, violation_type""",
    "global_count": "SELECT count(*) AS row_count FROM lineitem",
    "sample_topk": f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {fixed.SAMPLE_ROWS}",
    "delete_where": f"""
SELECT * FROM ({_SALARIES})
WHERE (segment = 'BUILDING' AND name > 'Customer#000000100') IS NOT TRUE""",
    "update_where": f"""
SELECT c_custkey, name,
       CASE WHEN segment = 'AUTOMOBILE' AND name LIKE 'Customer#%' THEN CAST(trunc(salary / 2.0 + 100) AS INTEGER)
            ELSE salary END AS salary,
       CASE WHEN segment = 'AUTOMOBILE' AND name LIKE 'Customer#%' THEN 'RAISED' ELSE segment END AS segment
FROM ({_SALARIES})""",
    "delete_in_place": "SELECT * FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice < 200000) IS NOT TRUE",
    "update_in_place": """
SELECT * REPLACE (CASE WHEN o_custkey % 7 = 3 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice) FROM orders""",
    "catalogue_branch": """
WITH main_then AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS o_totalprice,
         CAST(o_orderdate AS DATE) AS o_orderdate FROM orders),
firms_then AS (SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_suppkey % 11 <> 0)
SELECT 'trial' AS branch, 'orders' AS tab, o_orderkey AS id, o_orderstatus AS label, o_totalprice AS amount, o_orderdate AS "day"
FROM main_then WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'trial', 'orders', o_orderkey, o_orderstatus, o_totalprice, NULL FROM orders WHERE o_orderkey % 10 = 1
UNION ALL SELECT 'trial', 'supplier', s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal * 2 ELSE s_acctbal END, NULL
FROM firms_then
UNION ALL SELECT 'trial', 'supplier', s_suppkey + 1000000, s_name, s_acctbal, NULL FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL SELECT 'main', 'orders', o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM main_then WHERE o_orderkey % 2 <> 0
UNION ALL SELECT 'main', 'supplier', s_suppkey, 'renamed', s_acctbal, NULL FROM firms_then""",
    "branch_state": f"WITH {_HISTORY}, {_state('experiment', 'experiment')} SELECT * FROM experiment",
    "branch_isolation": f"""
WITH {_HISTORY}, {_state('experiment', 'experiment')}, {_state('main_now', 'main')},
{_state('main_alone', 'main', "branch = 'main'")}
SELECT 'main' AS compared,
       (SELECT count(*) FROM (SELECT * FROM main_now EXCEPT ALL SELECT * FROM main_alone)) AS added,
       (SELECT count(*) FROM (SELECT * FROM main_alone EXCEPT ALL SELECT * FROM main_now)) AS missing
UNION ALL
SELECT 'experiment',
       (SELECT count(*) FROM (SELECT * FROM experiment EXCEPT ALL SELECT * FROM main_now)),
       (SELECT count(*) FROM (SELECT * FROM main_now EXCEPT ALL SELECT * FROM experiment))""",
    "branch_drop": f"""
WITH {_HISTORY}, {_state('abandoned', 'abandoned')}, {_state('made_again', 'again')}
SELECT name, salary, 'abandoned' AS branch FROM abandoned
UNION ALL SELECT name, salary, 'again' FROM made_again""",
    "statement_clean": f"SELECT request_id, {_cleaned('text')} AS text FROM ({_REQUESTS})",
    "statement_split": _split("SELECT page_id AS request_id, html AS text FROM pages"),
    "statement_guard": _GUARDED,
    "guard_outcome": f"""
SELECT request_id, coalesce(n_kept, 0) AS n_kept, coalesce(n_blocked, 0) AS n_blocked,
       CASE WHEN coalesce(n_kept, 0) = 0 THEN 'no_valid' ELSE 'runnable' END AS outcome
FROM ({_REQUESTS}) LEFT JOIN (
  SELECT request_id, CAST(count(*) FILTER (WHERE verdict = 'kept') AS INTEGER) AS n_kept,
         CAST(count(*) FILTER (WHERE verdict = 'blocked') AS INTEGER) AS n_blocked
  FROM ({_GUARDED}) GROUP BY request_id) USING (request_id)""",
    "landing_export": f"""
SELECT *, CAST(floor(epoch("timestamp") / {fixed.TICK_SECONDS}) * {fixed.TICK_SECONDS} AS BIGINT) AS tick,
       CAST(floor(epoch("timestamp") / 86400) * 86400 AS BIGINT) AS first_tick FROM ({_TELEMETRY})""",
    "stream_ingest": _TELEMETRY,
    "stream_restart": _TELEMETRY,
    "stream_quarantine": """
SELECT 'good' AS verdict, event_type, CAST(NULL AS VARCHAR) AS reason, count(*) AS lines, CAST(NULL AS BIGINT) AS chars,
       CAST(NULL AS BIGINT) AS kept_ids
FROM events WHERE event_type NOT IN ('error', 'purchase') GROUP BY event_type
UNION ALL
SELECT 'bad', NULL, CASE event_type WHEN 'error' THEN 'not json' ELSE 'speed_kmh' END, count(*),
       CAST(sum(length('{"event_id":' || event_id || CASE event_type WHEN 'error' THEN '' ELSE ',"speed_kmh":"x"}' END)) AS BIGINT),
       CAST(sum(CASE event_type WHEN 'purchase' THEN event_id END) AS BIGINT)
FROM events WHERE event_type IN ('error', 'purchase') GROUP BY event_type""",
    "stream_counts": """
SELECT unnest(['seen', 'held']) AS what, n_rows, n_bad
FROM (SELECT count(*) AS n_rows, count(*) FILTER (event_type IN ('error', 'purchase')) AS n_bad FROM events)""",
    "late_files": f"""SELECT *, ("timestamp" < TIMESTAMP '2024-01-16 00:00:00') IS NOT TRUE AS late FROM ({_TELEMETRY})""",
    "snapshot_read": f"SELECT * FROM ({_TELEMETRY}) WHERE \"timestamp\" < TIMESTAMP '2024-01-16 00:00:00'",
    "list_partitions": "SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type",
    "compact_rows": _TELEMETRY,
    "compact_report": """
SELECT event_type, count(*) AS rows_before, count(*) AS rows_after, CAST(1 AS BIGINT) AS files_after, true AS fewer_files
FROM events GROUP BY event_type""",
    "small_file_audit": """
SELECT event_type, count(*) AS row_count, CAST(1 AS BIGINT) AS small_files_after, true AS merge_helps FROM events GROUP BY event_type""",
    "merge_bins": f"{_BINS} SELECT path, part, bytes, bin FROM kept",
    "merge_audit": f"""{_BINS}
SELECT part, file_count, bytes, small_files, file_count - coalesce(merged, 0) + coalesce(into_files, 0) AS files_after
FROM (SELECT part, count(*) AS file_count, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) FILTER (bytes < {_SMALL}) AS small_files
      FROM files GROUP BY part)
LEFT JOIN (SELECT part, count(*) AS merged, count(DISTINCT bin) AS into_files FROM kept GROUP BY part) USING (part)""",
    "energy_balance": f"""
SELECT event_id, {_VEHICLE} AS vehicle_id, platoon,
       floor((greatest(CAST(start * 1000000000 AS HUGEINT) - drained, 0) + 5000000) / 10000000) / 100.0 AS battery_kwh
FROM (SELECT event_id, user_id, CASE WHEN user_id % 5 < 3 THEN 'Platoon_A' ELSE 'Platoon_B' END AS platoon,
             CASE WHEN user_id % 5 < 3 THEN {fixed.START_BALANCE['Platoon_A']}
                  ELSE {fixed.START_BALANCE['Platoon_B']} END AS start,
             sum({_UNITS}) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS drained
      FROM events)""",
}
