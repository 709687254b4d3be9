"""Check a folder of generated SQL texts (request_id, text): statements with verdicts, and the outcome per request."""

from __future__ import annotations

import argparse

from tallystream.operators import statements
from tallystream.session import build_session, prepare


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--requests", required=True, help="parquet folder of the texts")
    parser.add_argument("--output", required=True, help="new folder for statements/ and outcomes/")
    options = parser.parse_args(argv)
    spark = prepare(build_session("check-statements"))
    requests = spark.read.parquet(options.requests)
    statements.guard(requests).write.parquet(f"{options.output}/statements")
    statements.outcome(requests).write.parquet(f"{options.output}/outcomes")


if __name__ == "__main__":
    main()
