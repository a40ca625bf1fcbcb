"""Table sources: Parquet, catalog tables, JDBC and the catalog listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_catalogue(spark: SparkSession, path: str, datasets: list[str] | DataFrame | None = None,
                   partition: str = "dataset") -> DataFrame:
    """A saved catalogue (Parquet, any compression) - filters and column
    choices downstream are pushed into the scan.  ``datasets`` keeps only
    those values of the partition column, so only their folders are read.

    ``datasets`` may be a table of names (its first column; repeated names
    count once): the names then stay in Spark, and the scan is pruned at run
    time by the filtered table (dynamic partition pruning)."""
    df = spark.read.parquet(path)
    if isinstance(datasets, DataFrame):
        names = datasets.select(F.col(f"`{datasets.columns[0]}`").alias(partition))
        # the optimizer prunes by a side with a comparison only; this one every name passes
        names = names.where(F.length(partition) >= 0)
        return df.join(names, partition, "left_semi").select(*df.columns)
    if datasets is not None:
        df = df.filter(F.col(partition).isin(*datasets))
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session catalog (managed or external)."""
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Read a database table; with ``partition_column`` and bounds the read is
    split into ``num_partitions`` range queries run in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return reader.load()


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Non-temporary tables as ``(table_schema, table_name)``, ordered."""
    stmt = f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES"
    shown = spark.sql(stmt)
    return (shown.filter(~F.col("isTemporary"))
            .select(F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name"))
            .orderBy("table_schema", "table_name"))
