"""Sinks: Parquet, JSON records, catalog tables and JDBC.

Each write is one Spark job, run by the executors in parallel; nothing is
collected on the driver.  Writers return where the data went so a caller can
read it back.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WRITE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def unique_table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> str:
    """Parquet export (``compression="gzip"`` writes ``*.gz.parquet``)."""
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> str:
    """One JSON record per row (line-delimited), written per partition."""
    writer = df.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)
    return path


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_by: Sequence[str] = (), path: str | None = None,
               bucket_by: tuple[int, Sequence[str]] | None = None) -> str:
    """Replace (or append to) a catalog table.

    ``path`` makes it an external table at a shared location; ``bucket_by``
    (``(n, cols)``) writes bucketed files so later joins on those columns
    need no shuffle.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: the length of text and binary ones, eight of
    any other, none of a null."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        n = F.octet_length(c) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.when(c.isNotNull(), 8)
        total = total + F.coalesce(n, F.lit(0))
    return total


class Replaced(NamedTuple):
    """What :func:`replace_table` wrote: rows and bytes of values as counted
    by the write itself, where they lie now and where the table lay before."""

    rows: int
    value_bytes: int
    location: str
    before: str | None


def replace_table(df: DataFrame, name: str, root: str) -> Replaced:
    """Replace the rows of an external Parquet table without a gap.

    The rows are written to a fresh folder under ``root`` (the write counts them
    on its way), and only then the table's location is set to it: readers see
    the old rows or the new ones, and a write that fails leaves the table as it
    was.  The table is created if there is none; its columns have to stay the
    same, a frame of other columns raises before anything is written.  The
    folder of the version before is left to the caller, as queries may still be
    reading it; ``df`` may read the table itself.
    """
    spark = df.sparkSession
    before = None
    if spark.catalog.tableExists(name):
        have, new = (f.simpleString() for f in (spark.table(name).schema, df.schema))
        if have != new:
            raise ValueError(f"{name} has the columns {have}, the new rows {new}")
        before = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}["Location"]
    location = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("value_bytes"))
    counted.write.mode("error").parquet(location)
    if before is None:
        create_table(spark, name, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), location=location)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return Replaced(seen.get["rows"], seen.get["value_bytes"], location, before)


def create_table(spark: SparkSession, name: str, columns_ddl: str, using: str = "parquet",
                 partition_by: Sequence[str] = (), location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with declared column types."""
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING {using}"]
    if partition_by:
        parts.append("PARTITIONED BY (" + ", ".join(partition_by) + ")")
    if location:
        parts.append(f"LOCATION '{location}'")
    spark.sql(" ".join(parts))
    return name


def parquet_to_table(spark: SparkSession, path: str, name: str, mode: str = "overwrite",
                     location: str | None = None) -> str:
    """Load a Parquet folder into a catalog table (external at ``location``);
    :func:`replace_table` of the folder's rows does so without a gap."""
    return save_table(spark.read.parquet(path), name, mode=mode, path=location)


# The catalogue's target table in a database, and the same
# columns as a Spark table (which has no keys: check_constraints tells).
CATALOGUE_DDL = (
    "full_path TEXT NOT NULL, file_id VARCHAR(20) PRIMARY KEY, file_name VARCHAR(255) NOT NULL, "
    "folder_name VARCHAR(255) NOT NULL, file_size BIGINT NOT NULL"
)
CATALOGUE_SPARK_DDL = (
    "full_path STRING NOT NULL, file_id VARCHAR(20) NOT NULL, file_name VARCHAR(255) NOT NULL, "
    "folder_name VARCHAR(255) NOT NULL, file_size BIGINT NOT NULL"
)
# Column types for a table that Spark creates through JDBC.
CATALOGUE_JDBC_TYPES = (
    "full_path TEXT, file_id VARCHAR(20), file_name VARCHAR(255), "
    "folder_name VARCHAR(255), file_size BIGINT"
)


def jdbc_options(url: str, table: str, properties: dict[str, str] | None = None, batchsize: int = 1000,
                 num_partitions: int | None = None, truncate: bool = True,
                 column_types: str | None = None) -> dict[str, str]:
    """Writer options for :func:`write_jdbc`.

    ``truncate=True`` keeps an existing table (and its keys) on overwrite
    instead of dropping and re-creating it; ``column_types`` sets the
    column types used when Spark does create the table.
    """
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize), "truncate": str(truncate).lower()}
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    if column_types:
        opts["createTableColumnTypes"] = column_types
    opts.update(properties or {})
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "overwrite", batchsize: int = 1000, num_partitions: int | None = None,
               truncate: bool = True, column_types: str | None = None) -> str:
    """Parallel JDBC write: each partition opens its own connection and sends
    batched inserts.  ``num_partitions`` caps the connections (the frame is
    coalesced to it).  Credentials come only from ``properties``."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    opts = jdbc_options(url, table, properties, batchsize, num_partitions, truncate, column_types)
    df.write.format("jdbc").options(**opts).mode(mode).save()
    return table
