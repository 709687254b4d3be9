"""Stream telemetry lines from a landing folder into a table, until stopped.

Run ``compact_telemetry`` beside it about every hour: at a batch in ten seconds a read then plans at most some
360 folders that are not merged yet, however long the stream runs. With ``--landing`` that job also takes in files
that came too late for the stream.
"""

from __future__ import annotations

import argparse

from tallystream import fixed_values as fixed
from tallystream.session import build_session, prepare
from tallystream.sources.landing import MAX_FILE_AGE
from tallystream.streaming.ingest import FILES_PER_BATCH, StreamTable, start_ingest


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--landing", required=True, help="folder the JSON lines arrive in")
    parser.add_argument("--root", required=True, help="folder of the table and its checkpoint")
    parser.add_argument("--interval", default=fixed.TRIGGER, help="time between two micro-batches")
    parser.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH, help="a backlog comes in as several batches")
    parser.add_argument("--files-per-partition", type=int, help="most files a batch may leave per partition value")
    parser.add_argument("--max-file-age", default=MAX_FILE_AGE, help="files older than the newest by more are left to the job that merges")
    parser.add_argument("--archive", help="folder to move files to when they were taken in")
    parser.add_argument("--once", action="store_true", help="take in what is there and end")
    options = parser.parse_args(argv)
    spark = prepare(build_session("ingest-telemetry"))
    table = StreamTable(options.root, files_per_partition=options.files_per_partition)
    query = start_ingest(spark, options.landing, table, max_file_age=options.max_file_age,
                         interval=None if options.once else options.interval,
                         files_per_batch=options.files_per_batch, archive=options.archive)
    query.awaitTermination()


if __name__ == "__main__":
    main()
