"""Zip archives as tables of members.

Unpacking is re-aimed from "extract next to the archive" to a table
``(archive, dest, member, length, content)``: every archive row is expanded
by ``mapInPandas`` on the executors, one member at a time, into output
batches bounded in bytes.  Nothing is written to a machine-local folder.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.functions import paths as P
from filelens.session import default_parallelism, ship_package
from filelens.sources.files import hadoop_glob

MEMBER_SCHEMA = "archive string, member string, length bigint, content binary"
PACKED_SCHEMA = "path string, length bigint, content binary"
#: Bytes of members in one batch handed to Spark; a task holds them twice for a moment.
DEFAULT_BATCH_BYTES = 8 << 20
#: What a member costs a task besides its bytes: its row in a batch, its entry in an open archive.
MEMBER_BYTES = 1 << 10
STAMP = (1980, 1, 1, 0, 0, 0)
URI_SCHEME = re.compile(r"^file:/*(?=/)")


def scan_archives(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """Archives directly inside ``root`` as ``(path, length, content)``.

    ``root`` is a folder, taken literally; the content column is read lazily,
    one file per row.  A folder without archives gives an empty table, one
    that does not exist raises.
    """
    base = root.rstrip("/")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    df = reader.load(hadoop_glob(base, literal=True))  # a folder that does not exist is an error
    df = df.select(P.strip_uri("path").alias("path"), F.col("length").cast("bigint").alias("length"), "content")
    plain = URI_SCHEME.sub("", base)
    return df.filter(F.col("path").startswith(plain + "/") & (F.instr(F.substring("path", len(plain) + 2, 1 << 20), "/") == 0))


def _unsafe(name: str) -> bool:
    parts = name.replace("\\", "/").split("/")
    return name.startswith("/") or ".." in parts


def _content(zf: zipfile.ZipFile, info: zipfile.ZipInfo, archive: str, record: bool) -> tuple[bytes | None, str | None]:
    """A member's bytes, or why there are none (raised unless ``record``)."""
    if _unsafe(info.filename):
        if not record:
            raise ValueError(f"unsafe member name {info.filename!r} in {archive}")
        return None, "unsafe member name"
    try:
        return zf.read(info), None
    except (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError) as exc:
        if not record:
            raise ValueError(f"cannot read member {info.filename!r} in {archive}: {exc}") from exc
        return None, f"bad member: {exc}"


def _frame(rows: list[tuple], cols: list[str]) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=cols)
    return pdf.assign(length=pd.array([None if pd.isna(n) else int(n) for n in pdf["length"]], "Int64"))


def _in_batches(rows: Iterator[tuple], cols: list[str], batch_bytes: int) -> Iterator[pd.DataFrame]:
    """Member rows in frames of about ``batch_bytes``; empty members count as well."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row[: len(cols)])
        size += (row[2] or 0) + MEMBER_BYTES
        if size >= batch_bytes:
            del row  # a frame handed on is not held while the next one is filled
            out, held, size = _frame(held, cols), [], 0
            yield out
            del out
    if held:
        yield _frame(held, cols)


def expand_archives(archives: DataFrame, path: str = "path", content: str = "content",
                    batch_bytes: int = DEFAULT_BATCH_BYTES, num_partitions: int | None = None,
                    errors: str = "raise") -> DataFrame:
    """One row per archive member: ``(archive, dest, member, length, content)``.

    Directory entries are skipped.  A member name that is absolute or climbs
    with ``..`` raises, since a consumer writing ``dest/member`` would leave
    ``dest``; so does a member that cannot be read.  ``dest`` is the archive
    path minus its suffix.

    ``errors="record"`` keeps going: an unreadable archive gives one row with
    null member fields, an unsafe or unreadable member one row with its name
    and null content, each with the reason in an extra ``error`` column, so no
    input disappears silently.

    ``num_partitions`` spreads the archive rows by hash of the path first - useful
    when the archives were produced by few tasks; a ``binaryFile`` scan of
    large archives already gives each its own task.

    Input batches hold whole archives: they are bounded by
    ``spark.sql.execution.arrow.maxBytesPerBatch`` (64 MB by default).
    :func:`expand_archive_files`, for archives on a shared mount, never holds
    a whole archive in memory.
    """
    if errors not in ("raise", "record"):
        raise ValueError("errors must be 'raise' or 'record'")
    record = errors == "record"
    cols = ["archive", "member", "length", "content"] + (["error"] if record else [])

    def rows_of(archive: str, blob: bytes | None) -> Iterator[tuple]:
        try:
            zf = zipfile.ZipFile(io.BytesIO(blob))
        except zipfile.BadZipFile as exc:
            if not record:
                raise ValueError(f"not a zip archive: {archive}") from exc
            yield archive, None, None, None, f"bad zip: {exc}"
            return
        with zf:
            for info in zf.infolist():
                if not info.is_dir():
                    data, error = _content(zf, info, archive, record)
                    yield archive, info.filename, None if data is None else len(data), data, error

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blobs = (row for pdf in batches for row in zip(pdf[path], pdf[content]))
        yield from _in_batches((row for archive, blob in blobs for row in rows_of(archive, blob)), cols, batch_bytes)

    ship_package(archives.sparkSession)
    source = archives.select(path, content)
    if num_partitions:
        source = source.repartition(num_partitions, path)
    schema = MEMBER_SCHEMA + (", error string" if record else "")
    members = source.mapInPandas(expand, schema)
    extra = ["error"] if record else []
    return members.select("archive", P.archive_dest("archive").alias("dest"), "member", "length", "content", *extra)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of an Arrow batch, each made when its turn comes: large values are not held twice."""
    columns = batch.columns
    for i in range(batch.num_rows):
        yield tuple(column[i].as_py() for column in columns)


def pack_archives(members: DataFrame, archive: str = "archive", member: str = "member",
                  content: str = "content", max_bytes: int = 16 << 20, compress_level: int = 1,
                  max_open: int = 32, max_held: int = 32 << 20) -> DataFrame:
    """Zip member rows into archives, ``(path, length, content)``.

    Packing runs per input partition without a shuffle: rows of one archive
    name that sit in one task are split into parts of at most ``max_bytes``
    named ``<stem>/part-<task>-<n>.zip``, so a name holding a large share of
    the rows still yields many bounded archives built by many tasks.
    Members are deflated at ``compress_level`` (0 stores them).  At most
    ``max_open`` parts are built at once per task (the oldest is closed
    first), and when all of them hold ``max_held`` bytes as packed, their
    directories included, the largest is closed: a task's memory follows
    neither from its rows nor from the number of archive names.
    """
    from pyspark import TaskContext

    schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("content", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        task = ctx.partitionId() if ctx else 0
        seq: dict[str, int] = {}
        method = zipfile.ZIP_DEFLATED if compress_level > 0 else zipfile.ZIP_STORED
        open_parts: dict[str, tuple[io.BytesIO, zipfile.ZipFile, int, int]] = {}
        held = 0

        def close(name: str) -> pa.RecordBatch:
            nonlocal held
            buf, zf, _, cost = open_parts.pop(name)
            held -= cost
            zf.close()
            n = seq.get(name, 0)
            seq[name] = n + 1
            stem = _strip_suffix(name)
            blob = buf.getvalue()
            return pa.RecordBatch.from_arrays([pa.array([v], field.type) for v, field in zip((f"{stem}/part-{task:05d}-{n:05d}.zip", len(blob), blob), schema)],
                                              schema=schema)

        for name, mem, data in (row for batch in batches for row in _rows(batch)):
            if name not in open_parts and len(open_parts) >= max_open:
                yield close(next(iter(open_parts)))
            if name not in open_parts:
                buf = io.BytesIO()
                zf = zipfile.ZipFile(buf, "w", method, compresslevel=compress_level or None)
                open_parts[name] = (buf, zf, 0, 0)
            buf, zf, size, cost = open_parts[name]
            # one fixed time stamp: the same rows always give the same bytes
            zf.writestr(zipfile.ZipInfo(mem, STAMP), bytes(data), method, compress_level or None)
            size += len(data)
            now = buf.tell() + MEMBER_BYTES * len(zf.infolist())
            held += now - cost
            open_parts[name] = (buf, zf, size, now)
            del buf, zf, data  # a closed part is not held while the next batch is read
            if size >= max_bytes:
                yield close(name)
            while held > max_held:
                yield close(max(open_parts, key=lambda part: open_parts[part][3]))
        for name in list(open_parts):
            yield close(name)

    ship_package(members.sparkSession)
    return members.select(archive, member, content).mapInArrow(pack, PACKED_SCHEMA)


def _strip_suffix(name: str) -> str:
    root, ext = posixpath.splitext(name)
    return root if ext else name


def expand_archive_files(spark: SparkSession, root: str, pattern: str = "*.zip",
                         num_partitions: int | None = None,
                         batch_bytes: int = DEFAULT_BATCH_BYTES) -> DataFrame:
    """Members of the archives directly inside ``root``, read by path.

    For archives on a mount every executor sees.  Stage 1 opens each archive
    and reads only its central directory, giving one row per member; these
    rows, not the content, are spread by hash; stage 2 reads each task's
    members in archive order, opening every archive once per task.  A member
    is known by its place in the directory, so equal names keep their own
    content.  One archive holding a large share of the data is thus read by
    many tasks, and memory is bound by the largest member rather than by the
    archive (no 2 GB row limit).  Same output as :func:`expand_archives`.
    """
    ship_package(spark)
    n = num_partitions or default_parallelism(spark)
    listed = scan_archives(spark, root, pattern).select("path")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple[str, int]] = []
            for archive in pdf["path"]:
                with zipfile.ZipFile(archive) as zf:
                    rows += [(archive, i) for i, info in enumerate(zf.infolist()) if not info.is_dir()]
            yield pd.DataFrame(rows, columns=["archive", "entry"])

    def contents(entries: Iterator[tuple]) -> Iterator[tuple]:
        zf = name = None
        for archive, entry in entries:
            if archive != name:
                if zf is not None:
                    zf.close()
                zf, name = zipfile.ZipFile(archive), archive
            info = zf.infolist()[entry]
            data, _ = _content(zf, info, archive, record=False)
            yield archive, info.filename, len(data), data
        if zf is not None:
            zf.close()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        entries = (row for pdf in batches for row in zip(pdf["archive"], pdf["entry"]))
        yield from _in_batches(contents(entries), ["archive", "member", "length", "content"], batch_bytes)

    rows = listed.mapInPandas(members, "archive string, entry bigint").repartition(n, "archive", "entry")
    got = rows.sortWithinPartitions("archive", "entry").mapInPandas(read, MEMBER_SCHEMA)
    return got.select("archive", P.archive_dest("archive").alias("dest"), "member", "length", "content")
