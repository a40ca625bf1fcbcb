"""Archive members as ordered chunks, for members larger than memory.

A member is inflated as a stream and given out in chunks of bounded size, so
neither an archive nor a member is ever held whole.  A stored (uncompressed)
member is read in ranges by several tasks.  Each chunk carries its share of the
member's CRC-32: the checksum of a concatenation is the exclusive-or of the
chunks' checksums, each shifted by the bytes that follow it, so a member is
checked by one mergeable aggregation (sum of lengths, exclusive-or of shares) in
any order, and no task has to see all of its chunks.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.functions import paths as P
from filelens.session import default_parallelism, ship_package
from filelens.sources.archives import _unsafe, scan_archives

CHUNKS = ("archive string, entry int, member string, size bigint, crc bigint, chunk int, start bigint, length bigint, "
          "crc_share bigint, content binary, error string")
_ENTRIES = "archive string, entry int, first int, last int, cost bigint, error string"
DEFAULT_CHUNK = 4 << 20
#: Bytes to read that one task gets on average, and chunks of a stored member that are read as one unit.
BYTES_A_TASK, CHUNKS_A_UNIT = 128 << 20, 16
#: Bytes of chunks in one batch handed to Spark.
BATCH_BYTES = 32 << 20
_READ = 1 << 16


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo CRC-32's (bit 31 is x^0)."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return product


def crc_shift(crc: int, n: int) -> int:
    """What a checksum contributes when ``n`` bytes follow: ``crc * x^(8 n)``."""
    power, square = 1 << 31, 1 << 23  # x^0, x^8
    while n:
        if n & 1:
            power = _times(square, power)
        square = _times(square, square)
        n >>= 1
    return _times(power, crc)


def _raw(f: BinaryIO, info: zipfile.ZipInfo) -> None:
    """Go to the first byte of a member's data."""
    f.seek(info.header_offset)
    header = f.read(30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    name, extra = struct.unpack("<HH", header[26:30])
    f.seek(name + extra, 1)


def _chunks(f: BinaryIO, info: zipfile.ZipInfo, size: int, first: int, last: int) -> Iterator[tuple[int, bytes]]:
    """``number, bytes`` of the chunks ``first`` to ``last`` (-1: all) of a member."""
    if info.flag_bits & 1:
        raise ValueError("encrypted member")
    _raw(f, info)
    if info.compress_type == zipfile.ZIP_STORED:
        f.seek(first * size, 1)
        stop = -(-info.file_size // size) - 1 if last < 0 else last
        for k in range(first, stop + 1):
            yield k, f.read(min(size, info.file_size - k * size))
        if not info.file_size:
            yield 0, b""
        return
    if info.compress_type != zipfile.ZIP_DEFLATED:
        raise ValueError(f"compression method {info.compress_type} is not supported")
    inflater, left, pending, out, k = zlib.decompressobj(-zlib.MAX_WBITS), info.compress_size, b"", bytearray(), 0
    while not inflater.eof:
        if not pending:
            pending = f.read(min(_READ, left))
            left -= len(pending)
        # a chunk that is full may leave output inside the inflater after the last byte of input
        more = inflater.decompress(pending, size - len(out))
        if not pending and not more and not inflater.eof:
            raise ValueError("compressed data ends early")
        out += more
        pending = inflater.unconsumed_tail
        if len(out) == size:
            yield k, bytes(out)
            out.clear()
            k += 1
    if out or not k:
        yield k, bytes(out)


def member_chunks(spark: SparkSession, root: str, pattern: str = "*.zip", chunk_bytes: int = DEFAULT_CHUNK, num_partitions: int | None = None,
                  errors: str = "raise") -> DataFrame:
    """Chunks of the members of the archives directly inside ``root``, which
    every executor sees.

    ``archive, entry, member, size, crc`` name the member, by its place in the
    directory, with what the archive says of it; ``chunk, start, length,
    content`` is the piece and ``crc_share`` its share of the checksum
    (:func:`member_totals` adds them up).  An empty member is one empty chunk;
    directories are left out.  ``errors="record"`` keeps going: what cannot be
    read gives a row with the reason in ``error`` and a null content.

    The directories are read first; their entries, not the content, are dealt
    out by hash, a large stored member in several ranges, over as many tasks as
    the bytes to read ask for.
    """
    if errors not in ("raise", "record"):
        raise ValueError("errors must be 'raise' or 'record'")
    record = errors == "record"
    ship_package(spark)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _ENTRIES.split(", ")]
        for pdf in batches:
            rows: list[tuple] = []
            for archive in pdf["path"]:
                try:
                    with zipfile.ZipFile(archive) as zf:
                        for entry, info in enumerate(zf.infolist()):
                            if info.is_dir():
                                continue
                            units, n = [(0, -1)], -(-info.file_size // chunk_bytes)
                            if info.compress_type == zipfile.ZIP_STORED and n > CHUNKS_A_UNIT:
                                units = [(k, min(k + CHUNKS_A_UNIT, n) - 1) for k in range(0, n, CHUNKS_A_UNIT)]
                            rows += [(archive, entry, a, b, max(info.file_size // len(units), 1), None) for a, b in units]
                except zipfile.BadZipFile as exc:
                    if not record:
                        raise ValueError(f"not a zip archive: {archive}") from exc
                    rows.append((archive, None, None, None, 1, f"bad zip: {exc}"))
            yield pd.DataFrame(rows, columns=columns).astype({"entry": "Int64", "first": "Int64", "last": "Int64"})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in CHUNKS.split(", ")]
        rows: list[tuple] = []
        held = 0

        def out() -> pd.DataFrame:
            return pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in ("entry", "size", "crc", "chunk", "start", "length", "crc_share")})

        opened, infos, name = None, [], None
        for pdf in batches:
            for archive, entry, first, last, _, error in pdf.itertuples(index=False):
                if not pd.isna(error):
                    rows.append((archive, None, None, None, None, None, None, None, None, None, error))
                    continue
                if archive != name:
                    if opened:
                        opened.close()
                    with zipfile.ZipFile(archive) as zf:
                        infos, name = zf.infolist(), archive
                    opened = open(archive, "rb")
                info = infos[int(entry)]
                what = (archive, int(entry), info.filename, info.file_size, info.CRC)
                try:
                    if _unsafe(info.filename):
                        raise ValueError("unsafe member name")
                    for k, data in _chunks(opened, info, chunk_bytes, int(first), int(last)):
                        start = k * chunk_bytes
                        share = crc_shift(zlib.crc32(data), max(info.file_size - start - len(data), 0))
                        rows.append((*what, k, start, len(data), share, data, None))
                        held += len(data)
                        if held >= BATCH_BYTES:
                            yield out()
                            rows, held = [], 0
                except (ValueError, zlib.error, OSError) as exc:
                    if not record:
                        raise ValueError(f"cannot read member {info.filename!r} in {archive}: {exc}") from exc
                    rows.append((*what, None, None, None, None, None, str(exc)))
        if opened:
            opened.close()
        if rows:
            yield out()

    entries = scan_archives(spark, root, pattern).select("path").mapInPandas(listed, _ENTRIES)
    if num_partitions is None:
        cost = entries.agg(F.sum("cost").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
        num_partitions = max(1, min(cost.n, max(default_parallelism(spark), -(-(cost.bytes or 0) // BYTES_A_TASK))))
    dealt = entries.repartition(num_partitions, "archive", "entry", "first").sortWithinPartitions("archive", "entry", "first")
    return dealt.mapInPandas(read, CHUNKS)


def member_totals(chunks: DataFrame) -> DataFrame:
    """``archive, dest, entry, member, length, crc32, n_chunks, ok, error`` of
    each member of :func:`member_chunks`: what its chunks add up to, and whether
    that is what the archive says.  An archive that could not be opened is one
    row without a member."""
    whole = chunks.groupBy("archive", "entry", "member", "size", "crc").agg(
        F.sum("length").alias("length"), F.expr("bit_xor(crc_share)").alias("crc32"), F.count("chunk").alias("n_chunks"), F.min("error").alias("error"))
    ok = F.col("error").isNull() & (F.col("length") == F.col("size")) & (F.col("crc32") == F.col("crc"))
    return whole.select("archive", P.archive_dest("archive").alias("dest"), "entry", "member", "length", "crc32", "n_chunks",
                        F.coalesce(ok, F.lit(False)).alias("ok"), "error")
