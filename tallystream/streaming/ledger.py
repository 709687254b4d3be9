"""The ledger of a streamed table: which input files each batch read, and how many rows they gave."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tallystream.sources import paths
from tallystream.sources.landing import CORRUPT, SOURCE_FILE, SOURCE_TIME

NOTED = StructType([StructField("file", StringType()), StructField("modified", TimestampType()),
                    StructField("n_rows", LongType()), StructField("n_bad", LongType())])


def facts(with_files: bool) -> list[Column]:
    """What is observed of a batch: rows, bad rows, and its files, of which there are as many as a batch may have."""
    files = [F.collect_set(F.struct(SOURCE_FILE, F.unix_micros(SOURCE_TIME).alias("modified"))).alias("files")] if with_files else []
    return [F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("n_bad"), *files]


def note(spark: SparkSession, folder: str, seen: dict) -> None:
    """Write what was observed: a row per file, or one without a file where none is known; times in microseconds."""
    files = [tuple(file) for file in seen.get("files") or []] or [(None, None)]
    rows = spark.createDataFrame(pa.table({
        "file": pa.array([file for file, _ in files], pa.string()), "modified": pa.array([time for _, time in files], pa.int64()),
        "n_rows": pa.repeat(pa.scalar(seen["n_rows"], pa.int64()), len(files)),
        "n_bad": pa.repeat(pa.scalar(seen["n_bad"], pa.int64()), len(files))}))
    (rows.withColumn("modified", F.timestamp_micros("modified")).coalesce(1).write.mode("overwrite")
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder))


def read(spark: SparkSession, root: str) -> DataFrame:
    """(file, modified, n_rows, n_bad, batch_id) of all batches and sweeps that were noted."""
    stored = StructType([*NOTED.fields, StructField("batch_id", LongType())])
    if not paths.children(spark, root, "batch_id="):
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(root)
