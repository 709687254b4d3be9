"""Merge the small files of a streamed table, beside the running stream, and show the files that hold it then.

With ``--landing`` files that came too late for the stream are taken in first.
"""

from __future__ import annotations

import argparse

from tallystream.operators import maintenance
from tallystream.session import build_session, prepare
from tallystream.sources.landing import MAX_FILE_AGE
from tallystream.streaming.ingest import StreamTable, take_late


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the table")
    parser.add_argument("--target-bytes", type=int, default=maintenance.TARGET_BYTES)
    parser.add_argument("--landing", help="folder the JSON lines arrive in")
    parser.add_argument("--max-file-age", default=MAX_FILE_AGE, help="the age that the stream was started with")
    options = parser.parse_args(argv)
    spark, table = prepare(build_session("compact-telemetry")), StreamTable(options.root)
    if options.landing:
        print(f"took in {take_late(spark, options.landing, table, options.max_file_age)} late files")
    done = maintenance.compact(spark, table, target_bytes=options.target_bytes)
    if done is None:
        print("nothing to merge")
        return
    print(f"merged {done.merged} files into {done.written}, up to batch {done.upto}")
    maintenance.audit_table(spark, table, options.target_bytes).show()


if __name__ == "__main__":
    main()
