"""Landing folder of JSON lines: export into it, and the stream that reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallystream import fixed_values as fixed
from tallystream.functions import times
from tallystream.sources import paths
from tallystream.sources.schemas import TELEMETRY

CORRUPT = "_corrupt_record"


ROWS_PER_FILE = 500_000
#: The stream remembers the files of this time. It skips a file that is older than the newest one by more; such a file
#: is found by the ledger of those taken in, and taken in beside the stream.
MAX_FILE_AGE = "7d"
#: Columns of a stream that tell where a line comes from.
SOURCE_FILE, SOURCE_TIME = "_source_file", "_source_time"


def export_lines(df: DataFrame, folder: str, order: list[str], files: int | None = None,
                 tick_of: str | None = None, tick_seconds: int = fixed.TICK_SECONDS,
                 folder_seconds: int | None = None, mode: str = "errorifexists") -> None:
    """Write rows as JSON lines, each file holding one stretch of the order.

    Ranges over a unique order split a busy tick over several files, so no tick has to fit one task;
    without ``files`` adaptive execution packs ranges by their measured size, and no file gets more than
    ``ROWS_PER_FILE`` rows. With ``tick_of`` a line's tick stands in the line, and its file lies in a
    folder named after the first tick of the line's stretch of ``folder_seconds`` (default: a tick). Spark
    moves files into place when they are whole, so a reader never meets half a file, and two exports of
    the same second cannot replace each other.
    """
    if tick_of:
        df = df.withColumns({"tick": times.tick(F.col(tick_of), tick_seconds),
                             "first_tick": times.tick(F.col(tick_of), folder_seconds or tick_seconds)})
        order = ["first_tick", "tick", *order]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    writer = (ranged.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE)
              .option("timestampFormat", times.ISO_MICROS).option("timeZone", "UTC"))
    if tick_of:
        writer = writer.partitionBy("first_tick")
    writer.json(folder)


def with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def stream_lines(spark: SparkSession, folder: str, schema: StructType = TELEMETRY,
                 files_per_batch: int | None = None, archive: str | None = None,
                 max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """Stream of the JSON lines in a folder, each file read once, with the file and its time beside each line.

    The stream remembers the files of the last ``max_file_age``; ``ingest.take_late`` takes in those that are older
    when they arrive.

    Every micro-batch lists the folder. With ``archive`` Spark moves files there once their batch is
    committed, so that the folder, and the time to list it, stays small.

    Unknown fields are dropped and missing ones are null. A line that does not parse, or holds a field
    of another type, keeps its text in ``_corrupt_record``.
    """
    reader = (spark.readStream.schema(with_corrupt(schema)).options(**paths.line_options(CORRUPT))
              .option("maxFileAge", max_file_age))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(folder).select(
        "*", F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_modification_time").alias(SOURCE_TIME))
