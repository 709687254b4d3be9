"""Table writes: named tables in the session catalogue, and folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallystream.session import settings


def _location(location: str | None) -> str:
    text = location.replace("\\", "\\\\").replace("'", "\\'") if location else ""
    return f" LOCATION '{text}'" if location else ""


def _column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_if_absent(spark: SparkSession, name: str, schema: StructType, *, partition_by: list[str] | None = None,
                     provider: str = "parquet", location: str | None = None) -> None:
    """Create an empty typed table; an existing one of that name stays as it is."""
    columns = ", ".join(f"{_column(f.name)} {f.dataType.simpleString()}" for f in schema)
    layout = f" PARTITIONED BY ({', '.join(map(_column, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}{layout}{_location(location)}")


def create_from(df: DataFrame, name: str, *, partition_by: list[str] | None = None,
                provider: str = "parquet", location: str | None = None) -> None:
    """Create a table from rows; raises when the name is taken."""
    writer = df.write.format(provider).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def create_or_replace(df: DataFrame, name: str, *, partition_by: list[str] | None = None,
                      provider: str = "parquet", location: str) -> None:
    """Create a table from rows, or replace all rows of one, which may be the one ``df`` reads.

    The rows go to a new folder first, and the name moves to it in one call of the catalogue: it names the old rows
    or the new ones and is never missing. If the write fails, the table stays as it was. A table that gets other
    columns, layout or provider is created anew, for which it is missing for a moment.

    Partitions are found in the folders and not kept in the catalogue, so they move with the folder.
    """
    spark = df.sparkSession
    writer = df.write.format(provider).mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(location)
    if spark.catalog.tableExists(name):
        if _shape(spark, name) == (_order(df, partition_by), partition_by or [], provider.lower()):
            spark.sql(f"ALTER TABLE {name} SET{_location(location)}")
            return
        spark.sql(f"DROP TABLE {name}")
    with settings(spark, spark__sql__hive__manageFilesourcePartitions="false"):
        create_if_absent(spark, name, df.schema, partition_by=partition_by, provider=provider, location=location)


def _order(df: DataFrame, partition_by: list[str] | None) -> list[tuple[str, str]]:
    """Columns and types in the order a table has them: those it is stored by come last."""
    last = partition_by or []
    types = dict(df.dtypes)
    return [(n, t) for n, t in df.dtypes if n not in last] + [(n, types[n]) for n in last]


def described(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalogue tells of a table beside its columns: Location, Provider, Partition Provider and more."""
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _shape(spark: SparkSession, name: str) -> tuple[list[tuple[str, str]], list[str], str] | None:
    """Columns, partition columns and provider of a table that keeps no partitions in the catalogue, else None."""
    facts = described(spark, name)
    stored_by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if stored_by and facts.get("Partition Provider") == "Catalog":
        return None
    return spark.table(name).dtypes, stored_by, facts.get("Provider", "").lower()


def full_refresh(df: DataFrame, name: str, **how) -> None:
    """Replace all rows of a table, like ``create_or_replace``; the columns must be those it has, if it is there."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and set(spark.table(name).dtypes) != set(df.dtypes):
        raise ValueError(f"the rows do not have the columns of {name}")
    create_or_replace(df, name, **how)


def append(df: DataFrame, name: str) -> None:
    """Add rows by column position, as INSERT does; rows that are there already are added again."""
    df.write.mode("append").insertInto(name)


def new_folder(df: DataFrame, folder: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write rows to a new folder and read it back with the schema it was written from.

    A folder that is there is refused, so no failed job can take its rows; ``create_or_replace`` moves a
    table's name from one folder to the next.
    """
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).select(df.columns)
