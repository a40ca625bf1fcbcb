"""Catalogue of arriving files with Structured Streaming.

The batch catalogue re-expressed over a growing tree: a ``binaryFile``
stream source picks up new files each micro-batch (only ``path`` / ``length``
/ ``modificationTime`` are selected, so bodies are not read), the same
column expressions derive id, name and folder, and the rows are appended to
a Parquet table.  The checkpoint location records which files were already
catalogued, so a restarted query - or one whose executors were lost -
continues without duplicates.

The file source lists the watched tree on every trigger, so for a very large
tree point it at where new files arrive (for example a glob over date
folders) and bound how far back it looks with ``max_file_age``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filelens.functions import paths as P
from filelens.operators.catalogue import with_file_columns
from filelens.session import default_parallelism
from filelens.sources.labels import LABEL_DDL

# The schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def catalogue_stream(spark: SparkSession, root: str, pattern: str | None = None,
                     max_files_per_trigger: int | None = None, max_file_age: str | None = None) -> DataFrame:
    """Streaming catalogue rows ``(full_path, file_id, file_name, folder_name,
    file_size, modified)`` for every file that appears below ``root``."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)  # e.g. "7d"
    # metadata only: merge the per-file scan splits into a few tasks per core
    files = reader.load(root).select(
        P.strip_uri("path").alias("full_path"),
        F.col("length").cast("bigint").alias("file_size"),
        F.col("modificationTime").alias("modified"),
    )
    return with_file_columns(files)


def append_catalogue(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                     partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append the stream to a Parquet table; ``available_now`` processes what
    is there in bounded batches and stops (a scheduled incremental job)."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(path)


def label_stream(spark: SparkSession, root: str, schema: str = LABEL_DDL, pattern: str = "*.json",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Label documents arriving below ``root``, parsed under ``schema``.

    Join the stream to a static catalogue with
    :func:`filelens.operators.catalogue.label_catalogue` (a stream-static
    inner join: each micro-batch of new labels meets the whole catalogue).
    """
    reader = (spark.readStream.schema(schema).option("multiLine", "true")
              .option("recursiveFileLookup", "true").option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(root)
