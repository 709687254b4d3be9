"""Small files: finding them and merging them, beside a stream that keeps writing."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystream.sources import paths
from tallystream.streaming.ingest import (GOOD, StreamTable, committed_parts, contents, read_rows, settled_files,
                                          write_rows)

TARGET_BYTES = 128 * 1024 * 1024


def is_small(target_bytes: int) -> Column:
    return F.col("bytes") < target_bytes * 3 // 4


def _bin(part: str, path: str, target_bytes: int) -> Column:
    """Number of the bin that a small file of a part begins in; large ones come after them and move none."""
    before = Window.partitionBy(part).orderBy("bytes", path).rowsBetween(Window.unboundedPreceding, -1)
    return F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes)


def bins(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(path, part, bytes, bin) of the small files to be merged: those of one part and bin make one file.

    Within a part, small files are laid end to end by size and path; a new bin begins at each full
    ``target_bytes``. A bin thus has less than two files' worth of that, and one with a single file is left alone.
    """
    small = files.where(is_small(target_bytes)).select("path", "part", "bytes", _bin("part", "path", target_bytes).alias("bin"))
    together = F.count(F.lit(1)).over(Window.partitionBy("part", "bin"))
    return small.withColumn("together", together).where("together > 1").drop("together")


def audit(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Per part of a listing (path, part, bytes): files, bytes, small ones, and the files that a merge leaves."""
    merged = bins(files, target_bytes).groupBy("part").agg(
        F.count(F.lit(1)).alias("merged"), F.count_distinct("bin").alias("into"))
    counted = files.groupBy("part").agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("bytes"), F.count_if(is_small(target_bytes)).alias("small_files"))
    joined = counted.alias("c").join(merged.alias("m"), F.col("c.part").eqNullSafe(F.col("m.part")), "left")
    after = F.col("file_count") - F.coalesce("merged", F.lit(0)) + F.coalesce("into", F.lit(0))
    return joined.select("c.part", "file_count", "bytes", "small_files", after.alias("files_after"))


def file_counts(rows: DataFrame, partition: str) -> DataFrame:
    """(value, file, bytes, n) of the files that rows are read from; no data column is read."""
    return (rows.select(partition, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
            .groupBy(partition, "file").agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")))


def file_audit(files: DataFrame, partition: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Per partition value: files, bytes, rows, small files, and the files a merge of these leaves, from ``file_counts``.

    Its grouping has one row per file and partition value and is made up within each scan task, so what is
    shuffled is about one row per file. A merge leaves a file for each bin that small files begin in.
    """
    small = is_small(target_bytes)
    placed = files.withColumn("bin", F.when(small, _bin(partition, "file", target_bytes)))
    return placed.groupBy(partition).agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("file_count"), F.sum("bytes").alias("bytes"),
        F.count_if(small).alias("small_files"), F.count_distinct("bin").alias("small_files_after"))


def audit_table(spark: SparkSession, table: StreamTable, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Audit of the files that hold the table's good rows now."""
    parts = [file_counts(rows.where(F.col("verdict") == GOOD), table.partition) for rows in committed_parts(spark, table)]
    if not parts:
        raise ValueError("there are no files")
    return file_audit(reduce(DataFrame.unionByName, parts), table.partition, target_bytes)


def _decoded(file: Column) -> Column:
    """A path as the file system has it; url_decode alone would take a plus sign for a space."""
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def _listed(spark: SparkSession, table: StreamTable, folders: list[str]) -> DataFrame:
    """(path, part, bytes) of the data files below some folders; path from the root on, part names the partition."""
    names = "|".join(root.rsplit("/", 1)[1] for root in table.data)
    path = F.regexp_extract(_decoded(F.col("file")), rf"/((?:{names})/[a-z_]+=\d+/verdict=.*)$", 1).alias("path")
    part = F.regexp_extract("path", r"/(verdict=[^/]*/[^/]*)/[^/]*$", 1).alias("part")
    return paths.listing(spark, *folders, only="*.parquet", recursive=True).select(path, "bytes").select("path", part, "bytes")


def table_files(spark: SparkSession, table: StreamTable) -> DataFrame:
    """(path, part, bytes) of the files that hold the table's rows now."""
    now = contents(spark, table)
    found = [settled_files(spark, table, now.round).select("path", "part", "bytes")] if now.round >= 0 else []
    found += [_listed(spark, table, now.folders)] if now.folders else []
    if not found:
        raise ValueError("there are no files")
    return reduce(DataFrame.unionByName, found).where("path IS NOT NULL")


@dataclass(frozen=True)
class Round:
    """What a merge did: files merged, files they became, and the last batch it looked at."""

    number: int
    merged: int
    written: int
    upto: int


def compact(spark: SparkSession, table: StreamTable, *, target_bytes: int = TARGET_BYTES) -> Round | None:
    """Merge the small files of the table, each value's by itself, in bins of ``target_bytes``.

    The plan covers all files of the table, those of earlier merges too; only files in a bin are read and written
    anew, and large ones stay where they are. Rows keep their batch, and committed folders are only read, so stream
    and readers go on meanwhile. Readers switch to the new files when the list of files is finished; the old ones
    stay for those that read them. Run one at a time. Returns None when there is nothing to merge and no batch to
    take into the list.
    """
    now = contents(spark, table)
    if not now.folders and now.round < 0:
        return None
    files = table_files(spark, table)
    chosen = bins(files, target_bytes).collect()
    if not chosen and not now.folders:
        return None
    number = now.round + 1
    pieces = {key: k for k, key in enumerate(sorted({(r["part"], r["bin"]) for r in chosen}))}
    gone = spark.createDataFrame(pa.table({
        "path": pa.array([r["path"] for r in chosen], pa.string()),
        "piece": pa.array([pieces[r["part"], r["bin"]] for r in chosen], pa.int32())}))
    left = files.join(gone, "path", "left_anti")
    if chosen:
        folder = f"{table.merged}/round={number}"
        _merge(spark, table, gone, [f"{table.root}/{r['path']}" for r in chosen], folder, len(pieces))
        left = left.unionByName(_listed(spark, table, [folder]))
    # A row without a path, so that a table without files has its facts too.
    left = left.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS path, CAST(NULL AS STRING) AS part, CAST(NULL AS BIGINT) AS bytes"))
    (left.select("path", "part", "bytes", F.lit(now.newest).cast("bigint").alias("upto"), F.lit(now.last_sweep).alias("sweep"))
     .coalesce(1).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
     .parquet(f"{table.files}/round={number}"))
    return Round(number, len(chosen), len(pieces), now.newest)


def _merge(spark: SparkSession, table: StreamTable, gone: DataFrame, names: list[str], folder: str, n: int) -> None:
    """Write the rows of the named files to a folder, one file for each piece that they are put into."""
    file = F.regexp_extract(_decoded(F.col("_metadata.file_path")), r"/([^/]+/[^/]+/verdict=.*)$", 1).alias("path")
    rows = [read_rows(spark, table, root, own).select("*", file)
            for root in table.data if (own := [name for name in names if name.startswith(f"{root}/")])]
    placed = reduce(DataFrame.unionByName, rows).join(gone, "path").drop("path")
    write_rows(table, placed.repartitionById(n, "piece").drop("piece"), folder)
