import re

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st

from tallystream import fixed_values as fixed
from tallystream.operators import statements

T, S, OK = fixed.TABLE, fixed.SYSTEM_PREFIX, fixed.ALLOWED_PROCEDURE
TO_MAIN = f"IN {fixed.CATALOG} FROM main"

CASES = [
    (f"```sql\nSELECT COUNT(*) FROM {T};\n```", [(f"SELECT COUNT(*) FROM {T}", "kept")]),
    (f"CALL {S}optimize_sweep('t')", [(f"CALL {S}optimize_sweep('t')", "blocked")]),
    (f"CALL {S}{OK}('{T}')", [(f"CALL {S}{OK}('{T}')", "kept")]),
    (f"CALL {S.upper()}rollback('t'); SELECT 1", [(f"CALL {S.upper()}rollback('t')", "blocked"), ("SELECT 1", "kept")]),
    (f"CREATE BRANCH IF NOT EXISTS e IN {T}", [(f"CREATE BRANCH IF NOT EXISTS e {TO_MAIN}", "kept")]),
    (f"CREATE BRANCH e IN {T} FROM main", [(f"CREATE BRANCH e {TO_MAIN} FROM main", "kept")]),
    (f"USE REFERENCE e IN {T}", [(f"USE REFERENCE e {TO_MAIN}", "kept")]),
    (f"ALTER TABLE {T} CREATE BRANCH e", [("CREATE BRANCH e", "kept")]),
    (f"SHOW PARTITIONS '{T}'", [(f"SHOW PARTITIONS {T}", "kept")]),
    (f'SHOW PARTITIONS "{T}"', [(f"SHOW PARTITIONS {T}", "kept")]),
    (f'show partitions "{T}"', [(f'show partitions "{T}"', "kept")]),
    ("SELECT 'a;b'", [("SELECT 'a", "kept"), ("b'", "kept")]),
    ("-- note\nSELECT 1", [("-- note SELECT 1", "kept")]),
    (f"DROP TABLE {T}", [(f"DROP TABLE {T}", "kept")]),
    (f"CALL {S}expire_snapshots('{OK}')", [(f"CALL {S}expire_snapshots('{OK}')", "kept")]),
    ("a\r\nb;\t", [("a\r b", "kept")]),
    (" ; ;\n", []),
    ("```sql```", []),
    ("", []),
    (None, []),
]


def by_request(rows):
    found = {}
    for row in sorted(rows, key=lambda r: (r.request_id, r.pos)):
        found.setdefault(row.request_id, []).append((row.statement, row.verdict))
    return found


def as_requests(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "request_id bigint, text string")


def plain(text):
    """The rules of the check in plain Python."""
    for fence in fixed.FENCES:
        text = text.replace(fence, "")
    text = text.strip().replace("\n", " ")
    for search, replacement in fixed.REWRITES:
        text = text.replace(search, replacement)
    result = []
    for part in text.split(";"):
        part = part.strip()
        lowered = part.lower()
        if part:
            result.append((part, "blocked" if S in lowered and OK not in lowered else "kept"))
    return result


def test_worked_examples(spark):
    requests = as_requests(spark, [text for text, _ in CASES])
    found = by_request(statements.guard(requests).collect())
    assert [found.get(i, []) for i in range(len(CASES))] == [expected for _, expected in CASES]


def test_outcomes(spark):
    outcomes = statements.outcome(as_requests(spark, [text for text, _ in CASES])).orderBy("request_id").collect()
    for (_, expected), row in zip(CASES, outcomes, strict=True):
        kept = sum(verdict == "kept" for _, verdict in expected)
        assert (row.n_kept, row.n_blocked) == (kept, len(expected) - kept)
        assert row.outcome == ("runnable" if kept else "no_valid")


pieces = st.sampled_from([*fixed.FENCES, ";", "\n", "\t", "\r", "\x1c", " ", " ", "SELECT 1", "'", T, S, S.upper(), OK,
                          "IN ", "ALTER TABLE ", "SHOW PARTITIONS ", f"'{T}'", f'"{T}"', "`", "sql", "é", "x"])


@hypothesis_settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(pieces, max_size=12).map("".join), min_size=40, max_size=80))
def test_check_follows_its_rules(spark, texts):
    found = by_request(statements.guard(as_requests(spark, texts)).collect())
    assert [found.get(i, []) for i in range(len(texts))] == [plain(text) for text in texts]


def test_positions_count_all_parts(spark):
    rows = statements.split(as_requests(spark, ["a; ;b"])).orderBy("pos").collect()
    assert [(r.pos, r.statement) for r in rows] == [(0, "a"), (2, "b")]


def test_own_rules(spark):
    rules = statements.GuardRules(fences=["~~~"], rewrites=[("foo", "bar")], system_prefix="sys.", allowed_procedure="ok")
    rows = statements.guard(as_requests(spark, ["~~~foo; CALL sys.x; CALL SYS.ok"]), rules).orderBy("pos").collect()
    assert [(r.statement, r.verdict) for r in rows] == [("bar", "kept"), ("CALL sys.x", "blocked"), ("CALL SYS.ok", "kept")]


@pytest.mark.parametrize("step", [statements.clean, statements.split, statements.guard, statements.outcome])
def test_no_shuffle(spark, step):
    plan = step(as_requests(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan.replace("PythonRDD", "")


def test_clean_up_is_compiled_before_the_array_functions(spark):
    plan = statements.outcome(as_requests(spark, ["a"]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"\*\(\d+\) Project \[request_id#\d+L, replace\(", plan)
