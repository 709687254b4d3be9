import datetime
import json
import os
import time
from collections import Counter
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from tallystream.operators import maintenance
from tallystream.operators.branches import row_differences
from tallystream.session import settings
from tallystream.sources.landing import export_lines
from tallystream.sources.schemas import TELEMETRY, schema_of
from tallystream.streaming import ingest, quarantine


@pytest.fixture
def table(folder):
    return ingest.StreamTable(folder)


def local(uri):
    return urlparse(uri).path


def land(folder, name, lines):
    os.makedirs(local(folder), exist_ok=True)
    with open(os.path.join(local(folder), name), "w") as out:
        out.writelines(line + "\n" for line in lines)


def line(vehicle, platoon="Platoon_A", moment="2025-03-01T10:00:00.123456", **more):
    return json.dumps({"vehicle_id": vehicle, "timestamp": moment, "speed_kmh": 60.5, "battery_kwh": 99.94,
                       "lidar_anomaly_flag": False, "cooperative_platoon_id": platoon, **more})


def vehicles(df):
    return sorted(r.vehicle_id for r in df.collect())


def test_edge_cases_of_lines(spark, table, folder):
    landing = f"{folder}/landing"
    land(landing, "a.json", [
        line("plain"),
        line("unknown field", colour="red"),
        '{"vehicle_id":"cut", "timest',
        line("bad types", moment="bad", speed_kmh="x"),
        '{"vehicle_id":"no platoon"}',
        line("whole second", moment="2025-03-01T10:00:01"),
        line("empty platoon", platoon=""),
        line("odd platoon", platoon="a/b=c 007"),
    ])
    ingest.ingest_available(spark, landing, table)
    rows = {r.vehicle_id: r for r in ingest.read_snapshot(spark, table).collect()}
    assert set(rows) == {"plain", "unknown field", "no platoon", "whole second", "empty platoon", "odd platoon"}
    utc = datetime.timezone.utc
    stamps = {r.vehicle_id: r.us for r in ingest.read_snapshot(spark, table).select(
        "vehicle_id", F.unix_micros("timestamp").alias("us")).collect()}
    assert stamps["plain"] == int(datetime.datetime(2025, 3, 1, 10, tzinfo=utc).timestamp()) * 10**6 + 123456
    assert stamps["whole second"] == int(datetime.datetime(2025, 3, 1, 10, 0, 1, tzinfo=utc).timestamp()) * 10**6
    assert rows["no platoon"].cooperative_platoon_id is None
    assert rows["empty platoon"].cooperative_platoon_id == ""
    assert rows["odd platoon"].cooperative_platoon_id == "a/b=c 007"
    bad = sorted(r.line for r in ingest.read_quarantine(spark, table).collect())
    assert len(bad) == 2 and bad[1] == '{"vehicle_id":"cut", "timest'
    assert json.loads(bad[0])["vehicle_id"] == "bad types"
    assert ingest.read_snapshot(spark, table).schema.fieldNames() == TELEMETRY.fieldNames()


def test_restart_adds_new_files_only(spark, table, folder):
    landing = f"{folder}/landing"
    land(landing, "a.json", [line("one")])
    ingest.ingest_available(spark, landing, table)
    land(landing, "a.json", [line("one"), line("rewritten")])
    land(landing, "b.json", [line("two")])
    for _ in range(2):
        ingest.ingest_available(spark, landing, table)
    assert vehicles(ingest.read_snapshot(spark, table)) == ["one", "two"]


def test_files_taken_in_are_archived(spark, table, folder):
    landing = f"{folder}/landing"
    for n in range(4):
        land(landing, f"{n}.json", [line(f"v{n}")])
        ingest.ingest_available(spark, landing, table, archive=f"{folder}/old")
    deadline = time.time() + 30
    while "0.json" in os.listdir(local(landing)) and time.time() < deadline:
        time.sleep(0.2)
    archived = [name for _, _, names in os.walk(local(f"{folder}/old")) for name in names if name.endswith(".json")]
    assert "0.json" in archived and "3.json" not in archived
    assert vehicles(ingest.read_snapshot(spark, table)) == ["v0", "v1", "v2", "v3"]


def test_a_replayed_batch_adds_nothing(spark, table, folder):
    landing = f"{folder}/landing"
    for n in range(3):
        land(landing, f"{n}.json", [line(f"v{n}")])
        ingest.ingest_available(spark, landing, table)
    newest = ingest.newest_batch(spark, table)
    commits = os.path.join(local(table.checkpoint), "commits")
    for name in (str(newest), f".{newest}.crc"):
        os.rename(os.path.join(commits, name), os.path.join(local(folder), "taken-" + name.strip(".")))
    ingest.ingest_available(spark, landing, table)
    assert ingest.newest_batch(spark, table) == newest
    assert vehicles(ingest.read_snapshot(spark, table)) == ["v0", "v1", "v2"]


def test_a_batch_without_its_mark_is_not_read_and_is_written_anew(spark, table):
    rows = spark.createDataFrame([("a", None, 1.0, 2.0, True, "P", None)],
                                 ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TELEMETRY) + ", _corrupt_record string")
    ingest.write_batch(table, rows, 0)
    ingest.write_batch(table, rows, 1)
    mark = os.path.join(local(table.batches), "batch_id=1", "_SUCCESS")
    os.rename(mark, mark.replace("_SUCCESS", "_taken"))
    assert ingest.newest_batch(spark, table) == 0
    assert ingest.read_snapshot(spark, table).count() == 1
    ingest.write_batch(table, rows, 1)
    ingest.write_batch(table, rows, 1)
    assert ingest.read_snapshot(spark, table).count() == 2


def test_leftovers_of_an_unfinished_write_do_not_stay(spark, table, folder):
    land(f"{folder}/landing", "a.json", [line("one")])
    rows = spark.read.schema(ingest.with_corrupt(TELEMETRY)).json(f"{folder}/landing")
    with settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        ingest.write_batch(table, rows.withColumn("cooperative_platoon_id", F.lit("stale")), 0)
        mark = os.path.join(local(table.batches), "batch_id=0", "_SUCCESS")
        os.rename(mark, mark.replace("_SUCCESS", "_taken"))
        ingest.write_batch(table, rows, 0)
    assert [r.cooperative_platoon_id for r in ingest.read_snapshot(spark, table).collect()] == ["Platoon_A"]


@pytest.mark.parametrize("kind", ["tick bigint", "day date"])
def test_other_partition_types(spark, folder, kind):
    name, sql_type = kind.split()
    schema = StructType([StructField("v", StringType()), StructField(name, DateType() if sql_type == "date" else LongType())])
    table = ingest.StreamTable(folder, schema, name)
    values = ["2025-01-01", "2025-01-02"] if sql_type == "date" else [7, 8]
    land(f"{folder}/landing", "a.json", [json.dumps({"v": f"v{i}", name: value}) for i, value in enumerate(values)] + ['{"v":"none"}'])
    ingest.ingest_available(spark, f"{folder}/landing", table)
    maintenance.compact(spark, table)
    rows = {r.v: r[name] for r in ingest.read_snapshot(spark, table).collect()}
    assert [str(rows["v0"]), str(rows["v1"]), rows["none"]] == [str(values[0]), str(values[1]), None]


def test_reserved_columns_are_refused(folder):
    schema = StructType([StructField("batch_id", LongType()), StructField("p", StringType())])
    with pytest.raises(ValueError):
        ingest.StreamTable(folder, schema, "p")
    with pytest.raises(ValueError):
        ingest.StreamTable(folder, TELEMETRY, "absent")


def test_end_of_the_run_of_marks_is_found(spark, table, monkeypatch):
    for last in [-1, 0, 1, 2, 6, 7, 8, 1000]:
        looked = []
        monkeypatch.setattr(ingest.paths, "is_complete",
                            lambda _, path, last=last: looked.append(path) or int(path.split("=")[-1]) <= last)
        assert ingest.newest_batch(spark, table) == last
        assert len(looked) <= 22
        assert ingest.newest_batch(spark, table, known=last) == last


def test_nothing_yet(spark, table):
    assert ingest.read_snapshot(spark, table).count() == 0
    assert ingest.read_quarantine(spark, table).count() == 0
    assert maintenance.compact(spark, table) is None
    with pytest.raises(ValueError):
        maintenance.audit_table(spark, table)
    with pytest.raises(ValueError):
        maintenance.table_files(spark, table)


def streamed(spark, table, folder, batches=4, rows=400):
    landing = f"{folder}/landing"
    data = spark.range(rows).select(
        F.concat(F.lit("AV-"), F.col("id")).alias("vehicle_id"),
        F.timestamp_micros(F.lit(1735689600123456) + F.col("id") * 7777777).alias("timestamp"),
        (F.col("id") % 120).cast("double").alias("speed_kmh"), F.lit(99.5).alias("battery_kwh"),
        (F.col("id") % 20 == 0).alias("lidar_anomaly_flag"),
        F.when(F.col("id") % 3 > 0, "Platoon_A").when(F.col("id") % 2 > 0, "Platoon_B").alias("cooperative_platoon_id"))
    export_lines(data, landing, ["timestamp", "vehicle_id"], files=batches)
    land(landing, "broken.json", ['{"vehicle_id":'])
    ingest.ingest_available(spark, landing, table, files_per_batch=1)
    return data


def test_files_of_a_partition_are_bounded(spark, folder):
    counts = {}
    for name, limit in [("free", None), ("bounded", 2)]:
        table = ingest.StreamTable(f"{folder}/{name}", files_per_partition=limit)
        landing = f"{folder}/{name}/landing"
        for n in range(6):
            land(landing, f"{n}.json", [line(f"v{n}-{i}", "hot" if i % 2 else f"P{i % 8}") for i in range(80)])
        with settings(spark, spark__sql__files__openCostInBytes=str(2 ** 40)):
            ingest.ingest_available(spark, landing, table)
        assert ingest.read_snapshot(spark, table).count() == 480
        audit = {r.cooperative_platoon_id: r.file_count for r in maintenance.audit_table(spark, table).collect()}
        counts[name] = audit["hot"]
        assert limit is None or max(audit.values()) <= limit
    assert counts["free"] == 6 and counts["bounded"] <= 2


def test_round_trip_to_the_microsecond(spark, table, folder):
    data = streamed(spark, table, folder)
    assert row_differences(ingest.read_snapshot(spark, table), data).isEmpty()
    assert ingest.newest_batch(spark, table) == 4


def test_compaction_keeps_rows_and_leaves_fewer_files(spark, table, folder):
    data = streamed(spark, table, folder)
    sums = [F.sum("row_count"), F.sum("file_count"), F.sum("small_files")]
    before = maintenance.audit_table(spark, table).agg(*sums).first()
    done = maintenance.compact(spark, table)
    after = maintenance.audit_table(spark, table).agg(*sums).first()
    assert before[0] == after[0] == 400 and after[1] == 3 < before[1] == before[2]
    # The one file of bad lines has none to be merged with.
    assert (done.number, done.merged, done.written, done.upto) == (0, before[1], 3, 4)
    assert row_differences(ingest.read_snapshot(spark, table), data).isEmpty()
    assert ingest.read_quarantine(spark, table).count() == 1
    assert maintenance.compact(spark, table) is None
    assert sum("/merged/" in file for file in ingest.read_snapshot(spark, table).inputFiles()) == 3


def test_merged_files_have_the_size_of_their_bin(spark, table, folder):
    streamed(spark, table, folder, batches=12, rows=12000)
    files = maintenance.table_files(spark, table)
    most = files.agg(F.max("bytes")).first()[0]
    target = 4 * most
    planned = maintenance.bins(files, target).select("part", "bin").distinct().count()
    done = maintenance.compact(spark, table, target_bytes=target)
    merged = maintenance.table_files(spark, table).where("path LIKE 'merged/%'")
    assert planned == done.written == merged.count() and planned > 3
    assert merged.agg(F.max("bytes")).first()[0] < 2 * target


def listed(*files):
    return [(f"f{k}", part, size) for k, (part, size) in enumerate(files)]


def test_bins_of_a_listing(spark):
    files = listed(("a", 10), ("a", 60), ("a", 30), ("a", 20), ("a", 40), ("a", 75), ("a", 200), ("b", 5), ("c", 74), ("c", 74), (None, 1), (None, 2))
    rows = spark.createDataFrame(files, "path string, part string, bytes long")
    got = {r.path: r.bin for r in maintenance.bins(rows, 100).collect()}
    # By size 10, 20, 30, 40 fill the first bin; 60 begins at 100 and stays alone, as does the only small file of b.
    assert got == {"f0": 0, "f3": 0, "f2": 0, "f4": 0, "f8": 0, "f9": 0, "f10": 0, "f11": 0}
    told = {r.part: (r.file_count, r.bytes, r.small_files, r.files_after) for r in maintenance.audit(rows, 100).collect()}
    assert told == {"a": (7, 435, 5, 4), "b": (1, 5, 1, 1), "c": (2, 148, 2, 1), None: (2, 3, 2, 1)}


def test_file_audit_counts_the_bins_of_small_files(spark):
    sizes = {"a": [10, 60, 30, 20, 40, 75, 200], "b": [5], "c": [74, 74], "d": [75, 300], None: [1, 2]}
    files = [(part, f"{part}{k}", size, 1) for part, own in sizes.items() for k, size in enumerate(own)]
    rows = spark.createDataFrame(files, "part string, file string, bytes long, n long")
    told = {r.part: (r.row_count, r.file_count, r.small_files, r.small_files_after) for r in maintenance.file_audit(rows, "part", 100).collect()}
    assert told == {"a": (7, 7, 5, 2), "b": (1, 1, 1, 1), "c": (2, 2, 2, 1), "d": (2, 2, 0, 0), None: (2, 2, 2, 1)}


def test_a_merge_leaves_the_files_that_the_audit_told(spark, table, folder):
    streamed(spark, table, folder, batches=12, rows=12000)
    target = 4 * maintenance.table_files(spark, table).agg(F.max("bytes")).first()[0]
    told = {r.cooperative_platoon_id: r.file_count - r.small_files + r.small_files_after
            for r in maintenance.audit_table(spark, table, target).collect()}
    maintenance.compact(spark, table, target_bytes=target)
    left = {r.cooperative_platoon_id: r.file_count for r in maintenance.audit_table(spark, table).collect()}
    assert told == left and max(left.values()) > 1


def test_large_files_are_untouched_after_six_rounds(spark, table, folder):
    landing, states = f"{folder}/landing", {}
    land(landing, "large.json", [line(f"large{n:04}-" + os.urandom(40).hex()) for n in range(600)])
    ingest.ingest_available(spark, landing, table)
    large = maintenance.table_files(spark, table).first()
    target = large.bytes
    for n in range(6):
        for k in range(2):
            land(landing, f"{n}-{k}.json", [line(f"v{n}-{k}"), line(f"w{n}-{k}", "Platoon_B")])
            ingest.ingest_available(spark, landing, table)
        done = maintenance.compact(spark, table, target_bytes=target)
        assert done.number == n and done.merged == (4 if n == 0 else 6) and done.written == 2
        files = {r.path: r.bytes for r in maintenance.table_files(spark, table).collect()}
        assert large.path in files and len(files) == 3
        states[n] = os.stat(os.path.join(local(folder), large.path)).st_mtime_ns
    assert len(set(states.values())) == 1
    assert len(vehicles(ingest.read_snapshot(spark, table))) == 600 + 24


def test_cuts_before_between_and_after_merges(spark, table, folder):
    landing = f"{folder}/landing"
    expected = []
    for n in range(5):
        land(landing, f"{n}.json", [line(f"v{n}"), "{"])
        ingest.ingest_available(spark, landing, table)
        expected.append(f"v{n}")
        if n in (1, 2, 4):
            maintenance.compact(spark, table)
        for cut in range(n + 1):
            assert vehicles(ingest.read_snapshot(spark, table, upto=cut)) == expected[:cut + 1]
            assert ingest.read_quarantine(spark, table, upto=cut).count() == cut + 1
    assert ingest.newest_round(spark, table) == 2


def test_an_unfinished_merge_is_not_read(spark, table, folder):
    landing = f"{folder}/landing"
    for n in range(4):
        land(landing, f"{n}.json", [line(f"v{n}")])
        ingest.ingest_available(spark, landing, table)
        if n == 1:
            maintenance.compact(spark, table)
    assert maintenance.compact(spark, table).number == 1
    mark = os.path.join(local(table.files), "round=1", "_SUCCESS")
    os.rename(mark, mark.replace("_SUCCESS", "_taken"))
    assert ingest.newest_round(spark, table) == 0
    assert vehicles(ingest.read_snapshot(spark, table)) == ["v0", "v1", "v2", "v3"]
    assert maintenance.compact(spark, table).number == 1
    assert ingest.newest_round(spark, table) == 1
    assert vehicles(ingest.read_snapshot(spark, table)) == ["v0", "v1", "v2", "v3"]


def test_values_that_folders_write_otherwise_are_merged(spark, table, folder):
    odd = ["a/b=c 007", "50%+1 {x}", "", "naïve 漢", "[q]*?"]
    for n in range(2):
        land(f"{folder}/landing", f"{n} +%.json", [line(f"v{n}{k}", platoon) for k, platoon in enumerate(odd)] + ['{"vehicle_id":"none"}'])
        ingest.ingest_available(spark, f"{folder}/landing", table)
    done = maintenance.compact(spark, table)
    assert (done.merged, done.written) == (12, 6)
    rows = Counter((r.vehicle_id[2:], r.cooperative_platoon_id) for r in ingest.read_snapshot(spark, table).collect())
    assert rows == Counter({**{(str(k), platoon): 2 for k, platoon in enumerate(odd)}, ("ne", None): 2})
    assert ingest.late_files(spark, f"{folder}/landing", table, "0s").isEmpty()


def test_reading_and_merging_while_the_stream_runs(spark, table, folder):
    landing = f"{folder}/landing"
    land(landing, "0.json", [line("v0")])
    query = ingest.start_ingest(spark, landing, table, interval="200 milliseconds", files_per_batch=1)
    try:
        seen = []
        for n in range(1, 6):
            land(landing, f"{n}.json.part", [])
            with open(os.path.join(local(folder), f"{n}"), "w") as out:
                out.write(line(f"v{n}") + "\n")
            os.rename(os.path.join(local(folder), f"{n}"), os.path.join(local(landing), f"{n}.json"))
            seen.append(vehicles(ingest.read_snapshot(spark, table)))
            if n == 3:
                maintenance.compact(spark, table)
        deadline = time.time() + 60
        while len(vehicles(ingest.read_snapshot(spark, table))) < 6 and time.time() < deadline:
            time.sleep(0.3)
    finally:
        query.stop()
    assert all(set(a) <= set(b) for a, b in zip(seen, seen[1:], strict=False))
    assert Counter(vehicles(ingest.read_snapshot(spark, table))) == Counter(f"v{n}" for n in range(6))


def test_partition_filter_reaches_the_folders(spark, table, folder):
    streamed(spark, table, folder)
    plan = ingest.read_snapshot(spark, table).where("cooperative_platoon_id = 'Platoon_B'").select("speed_kmh")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(verdict" in text.replace("isnotnull(verdict#", "(verdict") or "PartitionFilters: [isnotnull" in text
    assert "cooperative_platoon_id" in text.split("PartitionFilters")[1].split("]")[0]
    assert "ReadSchema: struct<speed_kmh:double>" in text


def test_export_by_tick(spark, folder):
    rows = spark.range(40).select(F.col("id").alias("n"), F.timestamp_seconds(F.col("id")).alias("timestamp"))
    export_lines(rows, f"{folder}/out", ["timestamp", "n"], files=3, tick_of="timestamp")
    back = spark.read.schema("n bigint, timestamp timestamp, tick bigint, first_tick bigint").json(f"{folder}/out")
    assert back.where("tick <> first_tick").isEmpty()
    assert {r.tick for r in back.collect()} == {0, 10, 20, 30}
    assert back.where("tick <> floor(unix_timestamp(timestamp) / 10) * 10").isEmpty()


def aged(folder, name, days):
    then = time.time() - days * 86400
    os.utime(os.path.join(local(folder), name), (then, then))


def test_late_files_are_found_and_taken_in_once(spark, table, folder):
    """Files whose time lies eight days before the newest one are not read by the stream, but by the sweep."""
    landing = f"{folder}/landing"
    for name, age in [("new", 0), ("late", 8), ("later", 9), ("x", 1)]:
        land(landing, f"{name}.json", [line(name), "{"] if age > 8 else [line(name)])
        aged(landing, f"{name}.json", age)
        ingest.ingest_available(spark, landing, table)
    assert vehicles(ingest.read_snapshot(spark, table)) == ["new", "x"]
    found = ingest.late_files(spark, landing, table)
    assert sorted(r.file.rsplit("/", 1)[1] for r in found.collect()) == ["late.json", "later.json"]
    cut = ingest.newest_batch(spark, table)
    assert ingest.take_late(spark, landing, table, files_per_batch=1) == 2
    assert ingest.late_files(spark, landing, table).isEmpty() and ingest.take_late(spark, landing, table) == 0
    assert vehicles(ingest.read_snapshot(spark, table)) == ["late", "later", "new", "x"]
    assert ingest.read_quarantine(spark, table).count() == 1
    # An earlier cut does not change; the next one has the late rows.
    assert vehicles(ingest.read_snapshot(spark, table, upto=cut)) == ["new", "x"]
    land(landing, "y.json", [line("y")])
    ingest.ingest_available(spark, landing, table)
    maintenance.compact(spark, table)
    assert vehicles(ingest.read_snapshot(spark, table, upto=cut + 1)) == ["late", "later", "new", "x", "y"]
    assert vehicles(ingest.read_snapshot(spark, table, upto=cut)) == ["new", "x"]
    counts = {r.batch_id: (r.files, r.n_rows, r.n_bad) for r in ingest.batch_counts(spark, table).collect()}
    assert counts == {0: (1, 1, 0), 1: (1, 1, 0), 2: (1, 1, 0), -1: (1, 2, 1), -2: (1, 1, 0)}


def test_a_sweep_that_died_is_taken_again(spark, table, folder):
    landing = f"{folder}/landing"
    for name, age in [("new", 0), ("late", 8)]:
        land(landing, f"{name}.json", [line(name)])
        aged(landing, f"{name}.json", age)
        ingest.ingest_available(spark, landing, table)
    ingest.take_late(spark, landing, table)
    noted = os.path.join(local(table.ledger), "batch_id=-1")
    os.rename(noted, os.path.join(local(folder), "taken"))
    assert vehicles(ingest.read_snapshot(spark, table)) == ["new"]
    assert ingest.take_late(spark, landing, table) == 1
    assert vehicles(ingest.read_snapshot(spark, table)) == ["late", "new"]


def test_a_batch_that_was_not_noted_is_noted_when_it_is_replayed(spark, table, folder):
    land(f"{folder}/landing", "a.json", [line("one"), "{"])
    ingest.ingest_available(spark, f"{folder}/landing", table)
    before = [tuple(r) for r in ingest.batch_counts(spark, table).collect()]
    noted = os.path.join(local(table.ledger), "batch_id=0")
    os.rename(noted, os.path.join(local(folder), "taken"))
    commits = os.path.join(local(table.checkpoint), "commits")
    for name in ("0", ".0.crc"):
        os.rename(os.path.join(commits, name), os.path.join(local(folder), "taken-" + name.strip(".")))
    ingest.ingest_available(spark, f"{folder}/landing", table)
    assert [tuple(r) for r in ingest.batch_counts(spark, table).collect()] == before == [(0, 1, 2, 1)]
    assert vehicles(ingest.read_snapshot(spark, table)) == ["one"]


def test_counts_of_a_running_stream_are_those_of_the_table(spark, table, folder):
    landing = f"{folder}/landing"
    land(landing, "0.json", [line("v0"), "{"])
    query = ingest.start_ingest(spark, landing, table, interval="200 milliseconds", files_per_batch=1)
    try:
        for n in range(1, 4):
            with open(os.path.join(local(folder), f"{n}"), "w") as out:
                out.write(line(f"v{n}") + "\n{}\n{\n")
            os.rename(os.path.join(local(folder), f"{n}"), os.path.join(local(landing), f"{n}.json"))
        deadline = time.time() + 60
        while ingest.batch_counts(spark, table).count() < 4 and time.time() < deadline:
            time.sleep(0.3)
    finally:
        query.stop()
    counted = {r.batch_id: (r.n_rows, r.n_bad) for r in ingest.batch_counts(spark, table).collect()}
    held = {r.batch_id: (r.n, r.bad) for r in ingest.read_committed(spark, table).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "bad").alias("bad")).collect()}
    assert counted == held and sum(n for n, _ in held.values()) == 11 and sum(bad for _, bad in held.values()) == 4


def test_why_lines_were_set_aside(spark):
    fields = schema_of({"n": "bigint", "x": "double", "ok": "boolean", "s": "string", "t": "timestamp", "it's": "int"})
    good = '"n":1,"x":2.5,"ok":true,"s":"a","t":"2025-01-01T00:00:00"'
    lines = {
        '{"n":': ("not json", []), "": ("not json", []), "[1]": ("not an object", []), "7": ("not an object", []),
        "{" + good + "}": ("unknown", []), '{"n":"1"}': ("n", ["n"]), '{"n":1.5,"x":"NaN"}': ("n", ["n"]), '{"n":null,"x":"q"}': ("x", ["x"]),
        '{"ok":"true","s":{"a":1},"t":"soon"}': ("ok,t", ["ok", "t"]), '{"it\'s":99999999999,"x":3}': ("it's", ["it's"]),
        '{"x":[1],"s":5,"n":12}': ("x", ["x"])}
    rows = spark.createDataFrame([(line,) for line in lines] + [(None,)], "line string")
    got = {r.line: r for r in quarantine.explain(rows, fields).collect()}
    assert {k: (r.reason, r.failed) for k, r in got.items()} == {**lines, None: ("not json", [])}
    assert got['{"x":[1],"s":5,"n":12}'].kept.asDict() == {"n": 12, "x": None, "ok": None, "s": "5", "t": None, "it's": None}
    kept = got["{" + good + "}"].kept
    assert (kept.n, kept.x, kept.ok, kept.s) == (1, 2.5, True, "a") and kept.t is not None
    # What the stream reads, no field is found to fail; what it sets aside is explained.
    parsed = rows.select("line", F.from_json("line", StructType([*fields, StructField("_c", StringType())]), {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_c"}).alias("p")).where("line IS NOT NULL AND line <> ''")
    for r in parsed.collect():
        assert (r.p is None or r.p["_c"] is not None) == (got[r.line].reason != "unknown"), r.line


def test_a_backlog_comes_in_as_several_batches(spark, table, folder):
    for n in range(7):
        land(f"{folder}/landing", f"{n}.json", [line(f"v{n}")])
    ingest.ingest_available(spark, f"{folder}/landing", table, files_per_batch=3)
    assert ingest.newest_batch(spark, table) == 2
    assert len(vehicles(ingest.read_snapshot(spark, table))) == 7
