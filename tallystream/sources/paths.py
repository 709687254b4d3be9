"""Looking at the file system that Spark itself writes to."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SUCCESS = "_SUCCESS"


def _path(spark: SparkSession, text: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether the write job of a folder finished: its mark is the last thing a job writes."""
    files, mark = _path(spark, f"{folder}/{SUCCESS}")
    return files.exists(mark)


def children(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """Names of the folders directly below a folder, without the prefix; finished or not."""
    files, pattern = _path(spark, f"{folder}/{prefix}*")
    return [status.getPath().getName()[len(prefix):] for status in files.globStatus(pattern) or []]


def remove(spark: SparkSession, folder: str) -> None:
    """Take a folder away, with what is in it."""
    files, path = _path(spark, folder)
    files.delete(path, True)


def move_files(spark: SparkSession, source: str, target: str, prefix: str = "part-") -> None:
    """Move the files directly below a folder whose names begin with a prefix; they keep their times."""
    for name in children(spark, source, prefix):
        files, path = _path(spark, f"{source}/{prefix}{name}")
        files.rename(path, _path(spark, f"{target}/{prefix}{name}")[1])


def listing(spark: SparkSession, *folders: str, only: str | None = None, recursive: bool = False) -> DataFrame:
    """(file, modified, bytes) of the files in some folders, as Spark lists them; contents are not read.

    Folders named like partitions are looked into, others below only with ``recursive``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if only:
        reader = reader.option("pathGlobFilter", only)
    facts = {"file": "file_path", "modified": "file_modification_time", "bytes": "file_size"}
    return reader.load(list(folders)).select(*[F.col(f"_metadata.{fact}").alias(name) for name, fact in facts.items()])


def read_lines(spark: SparkSession, files: list[str], schema: StructType, corrupt: str) -> DataFrame:
    """Rows of JSON lines by the rules that streams of them are read by."""
    return spark.read.schema(schema).options(**line_options(corrupt)).json(files)


def line_options(corrupt: str) -> dict[str, str]:
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "timeZone": "UTC"}


def seconds(age: str) -> int:
    """Seconds of a time like 90s, 15m, 36h or 7d."""
    found = re.fullmatch(r"(\d+)\s*(s|m|min|h|d)", age.strip())
    if not found:
        raise ValueError(f"{age} is not a number of seconds (s), minutes (m), hours (h) or days (d)")
    return int(found[1]) * {"s": 1, "m": 60, "min": 60, "h": 3600, "d": 86400}[found[2]]
