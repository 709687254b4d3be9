import os
import uuid

from conftest import SF_DIR
from tallystream.jobs import check_statements, compact_telemetry, ingest_telemetry, refresh_violations
from tallystream.streaming import ingest
from test_streams import land, line, local, vehicles


def test_refresh_shows_sample_and_report(spark, folder, capsys):
    name = "t_" + uuid.uuid4().hex
    source = f"{SF_DIR}/orders.parquet"
    refresh_violations.main(["--source", source, "--key", "o_orderkey", "--kind", "o_orderstatus", "--amount", "o_custkey",
                             "--table", name, "--location", f"{folder}/v1"])
    shown = capsys.readouterr().out
    assert "o_orderdate" in shown and "total_revenue" in shown
    table = spark.table(name)
    assert table.exceptAll(spark.read.parquet(source)).isEmpty() and table.count() == spark.read.parquet(source).count()


def test_ingest_and_merge(spark, folder, capsys):
    land(f"{folder}/landing", "a.json", [line("one"), line("two", "Platoon_B")])
    ingest_telemetry.main(["--landing", f"{folder}/landing", "--root", f"{folder}/table", "--once",
                           "--files-per-batch", "1", "--files-per-partition", "1"])
    land(f"{folder}/landing", "b.json", [line("three")])
    ingest_telemetry.main(["--landing", f"{folder}/landing", "--root", f"{folder}/table", "--once"])
    compact_telemetry.main(["--root", f"{folder}/table"])
    assert "merged 2 files into 1, up to batch 1" in capsys.readouterr().out
    compact_telemetry.main(["--root", f"{folder}/table"])
    assert "nothing to merge" in capsys.readouterr().out
    land(f"{folder}/landing", "old.json", [line("late")])
    os.utime(local(f"{folder}/landing/old.json"), (0, 0))
    ingest_telemetry.main(["--landing", f"{folder}/landing", "--root", f"{folder}/table", "--once"])
    compact_telemetry.main(["--root", f"{folder}/table", "--landing", f"{folder}/landing"])
    assert "took in 1 late files" in capsys.readouterr().out
    assert vehicles(ingest.read_snapshot(spark, ingest.StreamTable(f"{folder}/table"))) == ["late", "one", "three", "two"]


def test_statement_check(spark, folder):
    spark.createDataFrame([(1, "SELECT 1; SELECT 2")], "request_id bigint, text string").write.parquet(f"{folder}/in")
    check_statements.main(["--requests", f"{folder}/in", "--output", f"{folder}/out"])
    assert spark.read.parquet(f"{folder}/out/statements").count() == 2
    assert spark.read.parquet(f"{folder}/out/outcomes").first().outcome == "runnable"
