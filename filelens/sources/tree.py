"""``file_tree``: a Python data source that lists the files of a folder table.

The folders of a tree are found first, level by level (:func:`folders`), every
folder a row with the number of its files; :func:`listing` cuts them into slices
of bounded size and deals the slices to groups, whose number follows from the
number of files.  Each group is one input partition of the data source.  A
partition reads its slices from the shared folder, so the driver plans one entry
a group and holds no path; it stats its own files only, and filters on the path
or the size that Spark pushes down (``spark.sql.python.filterPushdown.enabled``)
skip folders, names and ``stat`` calls.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from filelens.session import default_parallelism, scratch_path, ship_package

LISTING = "full_path string, file_size bigint"
FOLDERS = "folder string, n_files bigint, link boolean, inode string"
#: Folders that one task lists in a round, on average, and files that one partition of the listing sizes.
FOLDERS_A_TASK, FILES_A_TASK = 2_000, 20_000
#: Files of a slice; a folder has at most ``MOST_SLICES`` of them (each reads all its names), larger ones beyond.
FILES_A_SLICE, MOST_SLICES = 10_000, 128
_BATCH_ROWS = 20_000
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def in_batches(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    batch: list[tuple] = []
    for row in rows:
        batch.append(row)
        if len(batch) == _BATCH_ROWS:
            yield pd.DataFrame(batch, columns=columns)
            batch = []
    if batch:
        yield pd.DataFrame(batch, columns=columns)


def _scanned(folder: str, follow_links: bool, recursive: bool) -> Iterator[tuple]:
    """The sub-folders of a folder, then the folder itself with its number of files."""
    n_files = 0
    with os.scandir(folder) as it:
        for entry in it:
            if not entry.is_dir(follow_symlinks=True):
                n_files += 1  # a dangling link too
            elif recursive and (link := entry.is_symlink()) <= follow_links:
                yield entry.path, None, link, _inode(entry.path) if link else None
    yield folder, n_files, None, _inode(folder) if follow_links else None


def _inode(path: str) -> str:
    at = os.stat(path)
    return f"{at.st_dev}:{at.st_ino}"


def _tasks(spark: SparkSession, units: int, a_task: int, wanted: int | None = None) -> int:
    return max(1, min(units, wanted or max(default_parallelism(spark), -(-units // a_task))))


def folders(spark: SparkSession, tops: DataFrame, follow_links: bool = False, recursive: bool = True) -> DataFrame:
    """``folder, n_files`` of the folders ``top`` and, if ``recursive``, of all
    below them.

    Each round lists the folders that the last one found, spread by hash over
    tasks by their number; what a round found is a table in the shared folder,
    so nothing of it passes through the driver, a deep one-branch tree is
    spread anew at each level, and a lost executor costs a round at most.

    With ``follow_links`` a link to a folder is entered under its own path, as
    a walk of the tree does.  The folders visited are kept by (device, inode),
    and a link that leads back to a folder on its own path is dropped by an
    anti-join with them: loops end, each file once a path without repetition.
    """
    ship_package(spark)
    columns = [c.split()[0] for c in FOLDERS.split(", ")]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = (r for folder in pdf["folder"] for r in _scanned(folder, follow_links, recursive))
            for out in in_batches(rows, columns):
                yield out.assign(n_files=out["n_files"].astype("Int64"), link=out["link"].astype("boolean"))

    level, rounds = tops.select(F.col(tops.columns[0]).alias("folder")), []
    while n := level.count():
        path = scratch_path(spark, "folders")
        level.repartition(_tasks(spark, n, FOLDERS_A_TASK), "folder").mapInPandas(scan, FOLDERS).write.parquet(path)
        rounds.append(path)
        found = spark.read.schema(FOLDERS).parquet(path).where("n_files IS NULL")
        visited = spark.read.schema(FOLDERS).parquet(*rounds).where("n_files IS NOT NULL")
        if follow_links:
            up = visited.select(F.col("folder").alias("above"), F.col("inode").alias("visited"))
            on_path = F.startswith(F.col("folder"), F.concat("above", F.lit("/")))
            no_loop = found.where("link").join(up, (F.col("inode") == F.col("visited")) & on_path, "left_anti")
            found = found.where("NOT link").unionByName(no_loop)
        level = found.select("folder")
    if not rounds:
        return spark.createDataFrame([], "folder string, n_files bigint")
    return visited.select("folder", "n_files")


def listing(spark: SparkSession, found: DataFrame, num_partitions: int | None = None, errors: str = "raise", pattern: str | None = None) -> DataFrame:
    """``full_path, file_size`` of the files directly inside the folders of
    ``folder, n_files``.

    ``pattern`` is a regular expression for whole file names.  A file without a
    size (removed meanwhile, a dangling link) raises, or with
    ``errors="keep"`` keeps a null size.
    """
    total = found.agg(F.sum("n_files").alias("n")).first().n or 0
    if not total:
        return spark.createDataFrame([], LISTING)
    tasks = _tasks(spark, total, FILES_A_TASK, num_partitions)
    each = max(1, min(FILES_A_SLICE, total // tasks))
    n = F.least(F.ceil(F.col("n_files") / each), F.lit(MOST_SLICES)).cast("int")
    slices = found.where("n_files > 0").withColumn("slices", n).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    slices = slices.select("folder", "slice", "slices", F.pmod(F.xxhash64("folder", "slice"), F.lit(tasks)).alias("group"))
    path = scratch_path(spark, "slices")
    slices.repartition(tasks, "group").write.partitionBy("group").parquet(path)
    options = {"slices": path, "errors": errors, "pushdown": str(spark.conf.get(_PUSHDOWN, "false")).lower()}
    if pattern:
        options["pattern"] = pattern
    register(spark)
    return spark.read.format(TreeSource.name()).options(**options).load()


def register(spark: SparkSession) -> None:
    """Make the format ``file_tree`` known to a session."""
    ship_package(spark)
    spark.dataSource.register(TreeSource)


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


class Group(InputPartition):
    """The slices of one partition, as a folder of the slice table."""

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class TreeReader(DataSourceReader):
    """Lists the slices of a group; what it leaves out is decided by ``tests``
    (on the path, from the name alone) and ``size_tests``."""

    def __init__(self, options: dict[str, str]):
        self.slices, self.keep = options["slices"], options.get("errors", "raise") == "keep"
        self.pattern = options.get("pattern")
        self.prefixes: list[str] = []
        self.tests: list[tuple[type, object, bool]] = []
        self.size_tests: list[tuple[type, object, bool]] = []

    def partitions(self) -> list[Group]:
        system, path = _opened(self.slices)
        return [Group(f.path) for f in sorted(system.get_file_info(pafs.FileSelector(path)), key=lambda f: f.path) if f.type == pafs.FileType.Directory]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.slices)
        schema = pa.schema([("full_path", pa.string()), ("file_size", pa.int64())])
        files = [f.path for f in system.get_file_info(pafs.FileSelector(partition.path)) if f.path.endswith(".parquet")]
        for file in sorted(files):
            with system.open_input_file(file) as f:
                rows = pq.ParquetFile(f).read().to_pylist()
            paths, sizes = [], []
            for row in rows:
                for path, size in self.files(row["folder"], row["slice"], row["slices"]):
                    paths.append(path)
                    sizes.append(size)
                    if len(paths) == _BATCH_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], schema=schema)
                        paths, sizes = [], []
            if paths:
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], schema=schema)

    def files(self, folder: str, slice_: int, slices: int) -> Iterator[tuple[str, int | None]]:
        inside = folder.rstrip("/") + "/"
        if any(not inside.startswith(p) and not p.startswith(inside) for p in self.prefixes):
            return
        named = re.compile(self.pattern).fullmatch if self.pattern else None
        with os.scandir(folder) as it:
            for entry in it:
                if slices > 1 and zlib.crc32(os.fsencode(entry.name)) % slices != slice_:
                    continue
                if named and not named(entry.name) or not all(_holds(entry.path, t) for t in self.tests) or entry.is_dir(follow_symlinks=True):
                    continue
                try:
                    size = os.stat(entry.path).st_size
                except OSError:
                    if not self.keep:
                        raise
                    size = None
                if all(size is not None and _holds(size, t) for t in self.size_tests):
                    yield entry.path, size


_COMPARE: dict[type, Callable] = {
    EqualTo: lambda v, x: v == x, In: lambda v, x: v in x,
    GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x, LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x,
    StringStartsWith: lambda v, x: v.startswith(x), StringEndsWith: lambda v, x: v.endswith(x), StringContains: lambda v, x: x in v,
}


def _holds(value, test: tuple[type, object, bool]) -> bool:
    kind, operand, wanted = test
    return _COMPARE[kind](value, operand) == wanted


class PushingTreeReader(TreeReader):
    """Takes over the filters that it can decide from a path or a size."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for pushed in filters:
            inner, wanted = (pushed.child, False) if isinstance(pushed, Not) else (pushed, True)
            column, operand = getattr(inner, "attribute", None), getattr(inner, "value", None)
            if type(inner) not in _COMPARE or operand is None or column not in (("full_path",), ("file_size",)) or isinstance(operand, tuple) and None in operand:
                yield pushed
                continue
            (self.tests if column == ("full_path",) else self.size_tests).append((type(inner), operand, wanted))
            if wanted and isinstance(inner, (StringStartsWith, EqualTo)) and column == ("full_path",):
                self.prefixes.append(operand)


class TreeSource(DataSource):
    """Option ``slices``: a table ``folder, slice, slices`` partitioned by ``group``."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> TreeReader:
        return (PushingTreeReader if self.options.get("pushdown") == "true" else TreeReader)(dict(self.options))
