"""Replace a table by the records of a source, then show a sample and the revenue by type."""

from __future__ import annotations

import argparse

from tallystream.operators import reports, writes
from tallystream.session import build_session, prepare


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", required=True, help="parquet folder of the records")
    parser.add_argument("--table", default="traffic_violations")
    parser.add_argument("--location", required=True, help="new folder for the rows of this refresh")
    parser.add_argument("--key", default="ticket_id", help="column that orders the sample")
    parser.add_argument("--kind", default="violation_type", help="column of the types")
    parser.add_argument("--amount", default="fine_amount", help="column of the amounts")
    options = parser.parse_args(argv)
    spark = prepare(build_session("refresh-violations"))
    writes.full_refresh(spark.read.parquet(options.source), options.table, location=options.location)
    table = spark.table(options.table)
    reports.first_rows(table, options.key).show()
    reports.revenue_by_type(table, options.kind, options.amount).show()


if __name__ == "__main__":
    main()
