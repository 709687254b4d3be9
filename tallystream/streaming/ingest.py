"""Streaming ingest into a folder of committed batches, and reading it while it grows.

Layout under one root::

    batches/batch_id=N/verdict=good|bad/<partition>=.../   one folder per micro-batch
    late/sweep=K/verdict=.../<partition>=.../              rows of files that came too late for the stream
    merged/round=K/verdict=.../<partition>=.../            rows of small files in fewer files
    files/round=K/                                         the files that hold the table's rows after round K
    ledger/batch_id=N/                                     the input files of a batch (-K: of a sweep), with counts
    checkpoint/                                            progress of the stream

A folder counts once it holds the mark of a finished write. It never changes after that: a batch that
is replayed is skipped when its mark exists, and written anew when it does not. So each input row is
in the table once, although ``foreachBatch`` alone only promises at least once. One write holds both
the good and the bad rows of a batch; they become visible together and the input is parsed once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallystream import fixed_values as fixed
from tallystream.session import settings
from tallystream.sources import paths
from tallystream.sources.landing import CORRUPT, MAX_FILE_AGE, SOURCE_FILE, SOURCE_TIME, stream_lines, with_corrupt
from tallystream.sources.schemas import TELEMETRY
from tallystream.streaming import ledger

GOOD, BAD = "good", "bad"
#: Files of a micro-batch unless the caller says otherwise: a backlog comes in as several batches.
FILES_PER_BATCH = 1000
#: Files or folders of a read that the driver lists by itself; more are listed by tasks.
LOOKED_UP = 256
_EMPTY = "__EMPTY_TEXT__"


@dataclass(frozen=True)
class StreamTable:
    """Where a streamed table lies and what it holds.

    A task writes a file for each partition value it meets. Where there are many values, set
    ``files_per_partition``: a batch is then shuffled, so that a value gets that many files at most.
    """

    root: str
    schema: StructType = TELEMETRY
    partition: str = fixed.PLATOON
    files_per_partition: int | None = None

    def __post_init__(self) -> None:
        taken = {"verdict", "batch_id", CORRUPT, SOURCE_FILE, SOURCE_TIME} & set(self.schema.fieldNames())
        if taken or self.partition not in self.schema.fieldNames():
            raise ValueError(f"columns {sorted(taken)} are taken, and {self.partition} must be a column")

    @property
    def batches(self) -> str:
        return f"{self.root}/batches"

    @property
    def late(self) -> str:
        return f"{self.root}/late"

    @property
    def merged(self) -> str:
        return f"{self.root}/merged"

    @property
    def data(self) -> list[str]:
        return [self.batches, self.late, self.merged]

    @property
    def files(self) -> str:
        return f"{self.root}/files"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def _is_text(table: StreamTable) -> bool:
    return isinstance(table.schema[table.partition].dataType, StringType)


def write_rows(table: StreamTable, rows: DataFrame, folder: str) -> None:
    """Write rows with their verdict in place of what an unfinished write may have left in the folder.

    An empty text cannot name a folder (Spark would read it back as null), so a mark stands for it.
    """
    if _is_text(table):
        value = F.col(table.partition)
        rows = rows.withColumn(table.partition, F.when(value == "", F.lit(_EMPTY)).otherwise(value))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("verdict", table.partition)
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder))


def _stored(table: StreamTable) -> StructType:
    return StructType([*with_corrupt(table.schema).fields, StructField("verdict", StringType()),
                       StructField("batch_id", LongType())])


def read_rows(spark: SparkSession, table: StreamTable, root: str, places: list[str]) -> DataFrame:
    """Rows of the named files or folders below a root, with ``verdict`` and ``batch_id``; no other is listed."""
    stored = _stored(table)
    # Some hundred names are looked up sooner by the driver than by a job.
    with settings(spark, spark__sql__sources__parallelPartitionDiscovery__threshold=str(LOOKED_UP)):
        rows = spark.read.schema(stored).option("basePath", root).parquet(*places).select(stored.fieldNames())
    if _is_text(table):
        value = F.col(table.partition)
        rows = rows.withColumn(table.partition, F.when(value == _EMPTY, F.lit("")).otherwise(value))
    return rows


def judged(lines: DataFrame) -> DataFrame:
    """Lines with their verdict: bad are those that did not parse."""
    return lines.withColumn("verdict", F.when(F.col(CORRUPT).isNull(), F.lit(GOOD)).otherwise(F.lit(BAD)))


def write_batch(table: StreamTable, batch: DataFrame, batch_id: int) -> None:
    """Write one micro-batch unless it is there already; without a shuffle, each task writes what it read.

    The rows are counted, and their files noted, while they are written; the ledger gets both afterwards. A batch
    that was written but not noted, because its job died in between, is counted by itself.
    """
    spark, folder = batch.sparkSession, f"{table.batches}/batch_id={batch_id}"
    noted = f"{table.ledger}/batch_id={batch_id}"
    known = {SOURCE_FILE, SOURCE_TIME} <= set(batch.columns)
    facts = ledger.facts(known)
    if paths.is_complete(spark, folder):
        if not paths.is_complete(spark, noted):
            ledger.note(spark, noted, batch.agg(*facts).first().asDict())
        return
    seen = Observation(f"batch {batch_id}")
    rows = judged(batch).observe(seen, *facts).drop(SOURCE_FILE, SOURCE_TIME)
    if table.files_per_partition:
        # A value that very many rows have is cut into as many pieces as it may have files.
        piece = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(table.files_per_partition))
        rows = (rows.withColumn("__piece", piece).repartition("verdict", table.partition, "__piece")
                .drop("__piece"))
    write_rows(table, rows, folder)
    ledger.note(spark, noted, seen.get)


def start_ingest(spark: SparkSession, landing: str, table: StreamTable, *,
                 interval: str | None = fixed.TRIGGER, files_per_batch: int = FILES_PER_BATCH,
                 archive: str | None = None, max_file_age: str = MAX_FILE_AGE) -> StreamingQuery:
    """Append the landing folder to the table, every ``interval``; with None, take what is there and end."""
    lines = stream_lines(spark, landing, table.schema, files_per_batch, archive, max_file_age)
    writer = (lines.writeStream.outputMode("append")
              .option("checkpointLocation", table.checkpoint)
              .foreachBatch(lambda batch, batch_id: write_batch(table, batch, batch_id)))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest_available(spark: SparkSession, landing: str, table: StreamTable,
                     files_per_batch: int = FILES_PER_BATCH, archive: str | None = None,
                     max_file_age: str = MAX_FILE_AGE) -> None:
    """Take in all files that are waiting, then stop."""
    start_ingest(spark, landing, table, interval=None, files_per_batch=files_per_batch, archive=archive,
                 max_file_age=max_file_age).awaitTermination()


def newest_batch(spark: SparkSession, table: StreamTable, known: int = -1) -> int:
    """Number of the last committed batch, -1 when there is none; ``known`` is one known to be there.

    A stream numbers its batches from 0 and starts one when the one before is committed, so the marks
    form a run without gaps. Its end is found with a few look-ups, doubling the step and then halving
    it, instead of listing every batch the stream ever wrote.
    """
    def committed(batch_id: int) -> bool:
        return paths.is_complete(spark, f"{table.batches}/batch_id={batch_id}")

    present, step = known, 1
    while committed(present + step):
        present, step = present + step, step * 2
    absent = present + step
    while absent - present > 1:
        middle = (present + absent) // 2
        present, absent = (middle, absent) if committed(middle) else (present, middle)
    return present


def newest_round(spark: SparkSession, table: StreamTable) -> int:
    """Number of the last finished merge, -1 when there is none; one that is not finished is written anew."""
    found = sorted((int(name) for name in paths.children(spark, table.files, "round=")), reverse=True)
    return next((k for k in found if paths.is_complete(spark, f"{table.files}/round={k}")), -1)


def sweeps(spark: SparkSession, table: StreamTable) -> list[int]:
    """Numbers of the sweeps for late files that are in the ledger, from 1."""
    found = (int(name) for name in paths.children(spark, table.ledger, "batch_id=-"))
    return sorted(k for k in found if paths.is_complete(spark, f"{table.ledger}/batch_id=-{k}"))


@dataclass(frozen=True)
class Contents:
    """Where a table's rows lie: files that a merge settled, and the folders that came after it."""

    settled: list[str]
    folders: list[str]
    newest: int
    last_sweep: int
    round: int

    def below(self, root: str) -> list[str]:
        return [place for place in [*self.settled, *self.folders] if place.startswith(f"{root}/")]


def settled_files(spark: SparkSession, table: StreamTable, number: int) -> DataFrame:
    """(path, part, bytes, upto, sweep): the files that make up the table after a merge; paths relative to the root."""
    return spark.read.parquet(f"{table.files}/round={number}")


def contents(spark: SparkSession, table: StreamTable) -> Contents:
    """What is committed now: the files after the last merge, and the batches and sweeps since.

    One row per file reaches the driver, which Spark's own listing of the table would hold there as well.
    """
    number = newest_round(spark, table)
    rows = settled_files(spark, table, number).select("path", "upto", "sweep").collect() if number >= 0 else []
    upto, sweep = (rows[0]["upto"], rows[0]["sweep"]) if rows else (-1, 0)
    newest, found = newest_batch(spark, table, known=upto), sweeps(spark, table)
    folders = [f"{table.batches}/batch_id={n}" for n in range(upto + 1, newest + 1)]
    folders += [f"{table.late}/sweep={k}" for k in found if k > sweep]
    return Contents([f"{table.root}/{r['path']}" for r in rows if r["path"]], folders, newest, max([sweep, *found]), number)


def committed_parts(spark: SparkSession, table: StreamTable, upto: int | None = None) -> list[DataFrame]:
    """All committed rows up to a batch, one frame for each kind of folder that holds some."""
    now, parts = contents(spark, table), []
    for root in table.data:
        places = now.below(root)
        if root == table.batches and upto is not None:
            places = [place for place in places if int(place[len(root) + 1:].split("/")[0].removeprefix("batch_id=")) <= upto]
        if places:
            rows = read_rows(spark, table, root, places)
            parts.append(rows if upto is None else rows.where(F.col("batch_id") <= upto))
    return parts


def read_committed(spark: SparkSession, table: StreamTable, upto: int | None = None) -> DataFrame:
    """All rows, good and bad, of the committed batches up to ``upto`` (default: the newest now).

    The cut is fixed once, at the start: a batch that commits later is not read, and a merge that ends later
    changes only which files hold the same rows. Rows of late files belong to the batch after the one that was the
    newest when they were taken in; without ``upto`` all of them are read.
    """
    parts = committed_parts(spark, table, upto)
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _stored(table))


def read_snapshot(spark: SparkSession, table: StreamTable, upto: int | None = None) -> DataFrame:
    """The table as of a committed batch: its good rows."""
    rows = read_committed(spark, table, upto)
    return rows.where(F.col("verdict") == GOOD).select(table.schema.fieldNames())


def read_quarantine(spark: SparkSession, table: StreamTable, upto: int | None = None) -> DataFrame:
    """Text of the lines that did not parse, with the batch they came in."""
    rows = read_committed(spark, table, upto)
    return rows.where(F.col("verdict") == BAD).select("batch_id", F.col(CORRUPT).alias("line"))


def batch_counts(spark: SparkSession, table: StreamTable) -> DataFrame:
    """(batch_id, files, n_rows, n_bad) of each committed batch, and of each sweep -K, as counted while it was written."""
    return ledger.read(spark, table.ledger).groupBy("batch_id").agg(
        F.count("file").alias("files"), F.max("n_rows").alias("n_rows"), F.max("n_bad").alias("n_bad"))


def late_files(spark: SparkSession, landing: str, table: StreamTable, max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """(file, modified, bytes) of the files that the stream will never read: not in the ledger, and too old.

    The stream looks at no file that is older than the newest one it read by more than ``max_file_age``.
    """
    known = ledger.read(spark, table.ledger)
    oldest = known.agg(F.max("modified") - F.expr(f"INTERVAL '{paths.seconds(max_file_age)}' SECOND")).scalar()
    listed = paths.listing(spark, landing).where(F.col("modified") < oldest)
    return listed.join(known.select("file"), "file", "left_anti")


def take_late(spark: SparkSession, landing: str, table: StreamTable, max_file_age: str = MAX_FILE_AGE,
              files_per_batch: int = FILES_PER_BATCH) -> int:
    """Take in the files that came too late for the stream, oldest first, beside it; returns how many there were.

    Each sweep takes ``files_per_batch`` at most. Its rows count once its files stand in the ledger; a sweep that died
    before is written anew. Run one at a time.
    """
    taken = 0
    while True:
        late = late_files(spark, landing, table, max_file_age).withColumn("micros", F.unix_micros("modified"))
        found = late.orderBy("modified", "file").limit(files_per_batch).collect()
        if not found:
            return taken
        number = max([0, *sweeps(spark, table)]) + 1
        lines = paths.read_lines(spark, [unquote(r["file"]) for r in found], with_corrupt(table.schema), CORRUPT)
        seen = Observation(f"sweep {number}")
        rows = judged(lines).withColumn("batch_id", F.lit(newest_batch(spark, table) + 1).cast("bigint"))
        write_rows(table, rows.observe(seen, *ledger.facts(False)), f"{table.late}/sweep={number}")
        ledger.note(spark, f"{table.ledger}/batch_id=-{number}",
                    seen.get | {"files": [(r["file"], r["micros"]) for r in found]})
        taken += len(found)
