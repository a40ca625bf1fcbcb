"""Document fingerprints by content-defined chunking.

A gear hash rolls over the text's bytes: its upper bits depend on the last 32
bytes only.  Where they are zero a chunk may end; up to the normal size under a
harder mask, beyond it under an easier one, so that sizes stay near normal
(normalised chunking).  Boundaries move with the content, so an insertion
changes the chunks around it and no others.  The fingerprint is the set of the
chunks' digests with their lengths, and two fingerprints are alike by the
length of the chunks they share.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.llm import common as C
from filelens.operators.batches import MOST_RANGES, cut_ranges

LEAST, NORMAL, MOST = 16, 40, 128
HARD, EASY = np.uint32(0xFC000000), np.uint32(0xF0000000)
SPAN = 32  # bytes that a hash depends on
DIGEST, ENTRY = 16, 18  # hex digits of a digest (64 bits); of a digest and its chunk's length

# a fixed pseudo-random number for each byte value
_GEAR = np.frombuffer(b"".join(hashlib.sha256(bytes([b])).digest()[:4] for b in range(256)), dtype="<u4").astype(np.uint32)


def _hashes(parts: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """Gear hashes of all bytes of ``parts`` and where each part begins; before
    a part lie ``SPAN`` empty places, so parts do not see each other."""
    pad = bytes(SPAN)
    begins, at = [], SPAN
    for p in parts:
        begins.append(at)
        at += len(p) + SPAN
    h = _GEAR[np.frombuffer(pad + pad.join(parts) + pad, dtype=np.uint8)]
    inside = np.zeros(len(h), dtype=bool)
    for b, p in zip(begins, parts, strict=True):
        inside[b : b + len(p)] = True
    h[~inside] = 0
    step = 1
    while step < SPAN:  # sums of 1, 2, 4 ... bytes
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    return h, begins


def chunk_ends(parts: list[bytes], skips: list[int] | None = None) -> list[list[int]]:
    """Ends of the chunks of each part; the first ``skips`` bytes of a part are
    there for the hash only, ends count from them."""
    h, begins = _hashes(parts)
    easy = np.flatnonzero(h & EASY == 0)
    hard = easy[h[easy] & HARD == 0].tolist()
    easy = easy.tolist()
    out = []
    for i, part in enumerate(parts):
        skip = skips[i] if skips else 0
        start, stop = begins[i] + skip, begins[i] + len(part)
        first, ends = start, []
        while start < stop:
            end = min(start + MOST, stop)
            k = bisect_left(hard, start + LEAST - 1)
            if k < len(hard) and hard[k] < start + NORMAL:
                end = min(hard[k] + 1, stop)
            else:
                k = bisect_left(easy, start + NORMAL)
                if k < len(easy) and easy[k] < end:
                    end = easy[k] + 1
            ends.append(end - first)
            start = end
        out.append(ends)
    return out


def _entries(data: bytes, ends: list[int], start: int = 0) -> list[str]:
    out, view = [], memoryview(data)
    for end in ends:
        out.append(xxhash.xxh64_hexdigest(view[start:end]) + f"{end - start:02x}")
        start = end
    return out


def likeness(a: str, b: str) -> float:
    """Length of the chunks that both fingerprints have, of the shorter one's:
    1 for equal texts and for a text contained in the other, 0 for nothing in
    common.  An empty text is like an empty text only."""
    if a == b:
        return 1.0
    x, y = ({f[i : i + ENTRY] for i in range(0, len(f), ENTRY)} for f in (a, b))
    weigh = lambda s: sum(int(e[DIGEST:], 16) for e in s)
    least = min(weigh(x), weigh(y))
    return weigh(x & y) / least if least else 0.0


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprint of each text: its distinct chunks, digest and length in hex, sorted."""
    data = [t.encode() for t in texts]
    return ["".join(sorted(set(_entries(d, e)))) for d, e in zip(data, chunk_ends(data), strict=True)]


def compare(texts: list[str], following: list[str]) -> list[tuple]:
    """For each text and the one that follows it: code points, digest of the
    edited text, both fingerprints, likeness to the edited and the next one's."""
    data = [t.encode() for t in texts]
    ends = chunk_ends(data)
    own = [_entries(d, e) for d, e in zip(data, ends, strict=True)]
    tails, skips, kept, digests = [], [], [], []
    for text, d, e, after in zip(texts, data, ends, following, strict=True):
        cut = len(text) // 4
        head = text[: len(text) - cut].encode() if cut else d
        edited = head + after[:cut].encode() if cut else d
        digests.append(hashlib.sha256(edited).hexdigest())
        # chunks that end in the untouched part stay as they are
        n = bisect_right(e, len(head)) if cut else len(e)
        start = e[n - 1] if n else 0
        before = max(0, start - SPAN + 1)
        kept.append(n)
        skips.append(start - before)
        tails.append(edited[before:])
    more = chunk_ends(tails, skips)
    out = []
    next_prints = fingerprints(following)
    for i, text in enumerate(texts):
        mine = "".join(sorted(set(own[i])))
        rest = _entries(tails[i][skips[i] :], more[i])
        edited = "".join(sorted({*own[i][: kept[i]], *rest}))
        out.append((len(text), digests[i], mine, edited, likeness(mine, edited), likeness(mine, next_prints[i])))
    return out


COLUMNS = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id`` and the columns of ``COLUMNS`` for every row, each held
    against the next row by ascending id (after the last: the first).

    A null text is empty.  Rows of equal id follow each other by the hash of
    their text, null ids come first; a single row is its own next.  The rows
    are cut into ranges of (id, hash of the text), so an id of many texts is cut
    too; a range's first row is also given to the range before it, so every
    range is worked through in order on its own, a few texts in memory at a
    time.  Rows that share both are copies and lie in one range.
    """
    spark = docs.sparkSession
    C.ready(spark)
    n_ranges = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), C.text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = cut_ranges(rows, ["doc_id", "h"], n_ranges, "part")
    firsts = sorted(rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "h")).alias("f")).collect(), key=lambda r: r.part)
    # one row a range: which range each range's first row is shown to
    shown = [(r.f.doc_id, r.f.h, firsts[i - 1].part) for i, r in enumerate(firsts)]
    shown = spark.createDataFrame(shown, "f_id bigint, f_h bigint, before int")
    rows = rows.join(F.broadcast(shown), rows.doc_id.eqNullSafe(F.col("f_id")) & (rows.h == F.col("f_h")), "left")
    places = F.array_compact(F.array(
        F.struct(F.col("part").alias("part"), F.lit(False).alias("guest")),
        F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("part"), F.lit(True).alias("guest")))))
    rows = rows.select("doc_id", "text", "h", F.explode(places).alias("p")).select("doc_id", "text", "h", "p.part", "p.guest")
    rows = rows.repartitionById(n_ranges, F.col("part")).sortWithinPartitions("part", "guest", "doc_id", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows whose next one is not known yet: at most the last of a batch
        for batch in C.slices(batches, "text"):
            held += zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text")), strict=True)
            pairs = [(a, b) for a, b in zip(held, held[1:], strict=False) if not a[1] and a[0] == b[0]]
            held = held[-1:]
            if pairs:
                found = compare([a[3] for a, _ in pairs], [b[3] for _, b in pairs])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*((a[2], *r) for (a, _), r in zip(pairs, found, strict=True)), strict=True), types, strict=True)],
                    names=names)

    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    names = ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))]
    return rows.select("part", "guest", "doc_id", "text").mapInArrow(run, f"doc_id bigint, {COLUMNS}")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, their edited texts and their next ones."""
    return compare_with_next(C.table(spark, sf_dir, "documents"))
