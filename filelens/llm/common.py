"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelens.session import ensure_checkpoint_dir, scratch_path, ship_package

#: Rows that a Python task works on at once; Arrow batches are cut to it.
ROWS_AT_ONCE = 512
#: Text bytes that a Python task works on at once (one row may be longer).
BYTES_AT_ONCE = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, opened by Spark's own reader (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: later reads of the rows survive the loss of executors
    and do not repeat the work.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tag(stem: str) -> str:
    """A column name that no input has."""
    return f"__{stem}_{uuid.uuid4().hex[:8]}"


def refuse(df: DataFrame, *names: str) -> None:
    """Raise if ``df`` has a column of a name that a result adds (case does not count)."""
    if clash := {n.lower() for n in names} & {c.lower() for c in df.columns}:
        raise ValueError(f"input already has column(s) {sorted(clash)}; rename them first")


def ready(spark: SparkSession) -> None:
    """Ship the package to the executors; have a checkpoint folder."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def slices(batches: Iterable[pa.RecordBatch], size_of: str | None = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches to ``ROWS_AT_ONCE`` rows and about ``BYTES_AT_ONCE``
    bytes of column ``size_of``, so a task holds few texts at a time."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            stop = min(start + ROWS_AT_ONCE, batch.num_rows)
            if size_of is not None:
                while stop - start > 1 and batch.column(size_of).slice(start, stop - start).nbytes > BYTES_AT_ONCE:
                    stop = start + (stop - start) // 2
            yield batch.slice(start, stop - start)
            start = stop


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str,
              size_of: str | None = None) -> DataFrame:
    """``fn`` over bounded Arrow batches of ``df``; rows are independent, so a
    lost task is simply run again."""
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, size_of):
            yield fn(piece)

    return df.mapInArrow(run, schema)


#: Slots of the bitmap that :func:`prefiltered` broadcasts (512 KiB at any input size, if no other number is given).
SLOT_BITS, _MAP_BITS = 22, 15
#: Most slots of a bitmap (16 MiB).
MOST_BITS = 27


def slot_bits(n: int, each: int = 8) -> int:
    """Bits of a slot's number, so that each of ``n`` keys has ``each`` slots, within bounds."""
    return min(max((each * max(n, 1) - 1).bit_length(), SLOT_BITS), MOST_BITS)


def slot_maps(wanted: DataFrame, slot: F.Column) -> DataFrame:
    """``bucket, bits``: which slots occur, as at most 2^(SLOT_BITS - 15) bitmaps."""
    rows = wanted.select(slot.cast("bigint").alias("slot"))
    return rows.groupBy(F.shiftright("slot", _MAP_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND((1 << _MAP_BITS) - 1)).alias("bits"))


def prefiltered(rows: DataFrame, wanted: DataFrame, *keys: str, bits: int = SLOT_BITS) -> DataFrame:
    """The rows whose ``keys`` occur in ``wanted``, and a few others.

    A hash of the keys picks a slot of a bitmap of fixed size (``2^bits``
    slots), which is broadcast; rows whose slot is empty go before any shuffle.
    The join that follows makes the result exact.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    maps = slot_maps(wanted, slot)
    b, m, s = tag("bucket"), tag("map"), tag("slot")
    maps = maps.select(F.col("bucket").alias(b), F.col("bits").alias(m))
    at = F.col(s).bitwiseAND((1 << _MAP_BITS) - 1)
    byte = F.conv(F.hex(F.substring(m, F.shiftright(at, 3).cast("int") + 1, 1)), 16, 10).cast("int")
    found = rows.withColumn(s, slot).join(F.broadcast(maps), F.shiftright(s, _MAP_BITS) == F.col(b))
    return found.where(F.call_function("shiftright", byte, at.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1).select(*rows.columns)


def split_by(rows: DataFrame, wanted: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose ``keys`` occur in ``wanted`` and a few others,
    and those whose slot of the bitmap (see :func:`prefiltered`) is empty, which
    need no shuffle to meet ``wanted``."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(1 << SLOT_BITS))
    b, m, s = tag("bucket"), tag("map"), tag("slot")
    maps = slot_maps(wanted, slot).select(F.col("bucket").alias(b), F.col("bits").alias(m))
    at = F.col(s).bitwiseAND((1 << _MAP_BITS) - 1)
    byte = F.conv(F.hex(F.substring(m, F.shiftright(at, 3).cast("int") + 1, 1)), 16, 10).cast("int")
    found = rows.withColumn(s, slot).join(F.broadcast(maps), F.shiftright(s, _MAP_BITS) == F.col(b), "left")
    hit = F.coalesce(F.call_function("shiftright", byte, at.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    return found.where(hit).select(*rows.columns), found.where(~hit).select(*rows.columns)


class Slots:
    """Which hashes occur in a column of evenly spread 64-bit hashes, as a
    broadcast bitmap: eight slots a distinct hash (or ``each``), within bounds (512 KiB to
    16 MiB), so a task can drop most rows that have no partner before a shuffle.
    A hash that occurs is always held."""

    def __init__(self, spark: SparkSession, hashes: DataFrame, column: str, each: int = 8):
        self.bits = slot_bits(hashes.count(), each)
        bitmap = np.zeros((1 << self.bits) // 8, np.uint8)
        size = (1 << _MAP_BITS) // 8
        for row in slot_maps(hashes, F.col(column).bitwiseAND(F.lit((1 << self.bits) - 1))).toLocalIterator():  # at most 4096 bitmaps
            bitmap[row.bucket * size : (row.bucket + 1) * size] |= np.frombuffer(row.bits, np.uint8)
        self.shared = spark.sparkContext.broadcast(bitmap)

    def hold(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes & ((1 << self.bits) - 1)
        return (self.shared.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def text_or_empty(col: str = "text") -> F.Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


_KEPT: dict[tuple, object] = {}


def kept(key: tuple, build: Callable[[], object]):
    """What a worker keeps under ``key`` from batch to batch.

    Workers are used again by the tasks of later operators, so a worker keeps
    the state of one: another's (a vocabulary, ids or hashes of words seen) goes
    before this is built, and memory does not add up over a pipeline.
    """
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


class SharedFile:
    """A file of bounded size (a vocabulary, a model), read on the driver and
    broadcast; ``made`` keeps what a worker builds from it for its next tasks."""

    MOST_BYTES = 64 << 20

    def __init__(self, spark: SparkSession, data: bytes):
        if len(data) > self.MOST_BYTES:
            raise ValueError(f"{len(data)} bytes are too many to broadcast")
        self.key = hashlib.md5(data).hexdigest()
        self.data = spark.sparkContext.broadcast(data)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> SharedFile:
        with open(path, "rb") as f:
            return cls(spark, f.read())

    def made(self, build: Callable, *args):
        return kept((build, self.key, args), lambda: build(self.data.value, *args))
