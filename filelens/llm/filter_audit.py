"""How five filters interact: every order of them, step by step.

A document's outcome depends on which filters it fails (its mask, 32 of them)
and on two label flags.  Every mask maps to one big integer, a wide packed
counter: a field for each of the outcomes (kept, removed, ...) of each of the
600 steps (120 orders of five filters).  The integers of a part's documents are
added up; one addition moves all fields.  A field has ``FIELD_BITS`` bits, more
than the rows of any table need, so no field overflows into the next, and the
sum is unpacked once a part.

Equal texts fail the same filters A to D, so the copies of a text are counted by
digest, part and flags first; only the copies of the smallest id pass E.  A text
that a third of all documents share is a few rows a task before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.llm import common as C

LETTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(LETTERS))
STEPS = len(ORDERS) * len(LETTERS)
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BITS = 64
#: Parts whose sums a task holds at once (each about 29 kB).
PARTS_AT_ONCE = 256
#: Sums that one task of the first round of additions receives of a part, by dealing.
SHARES = 16

# The five filters' limits and characters.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 100, 80, 10
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOLS = b"#$%&*|"


def fails(text: str) -> int:
    """Bits of the filters A to D that a text fails.

    ASCII white space is the same in UTF-8 bytes as in code points, and so are
    the characters looked for."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    plain = data.translate(None, _SYMBOLS)
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT * len(words)) << 1
            | (100 * (len(data) - len(data.translate(None, _CAPITALS))) > MAX_CAPITALS * len(text)) << 2 | (len(plain) < len(data)) << 3)


def outcomes(mask: int, good: bool, toxic: bool) -> dict[tuple[str, int], tuple[str, ...]]:
    """What happens to a document that fails the filters of ``mask``: the
    outcomes of each ``order, step``."""
    out = {}
    for order in ORDERS:
        gone = False
        for step, letter in enumerate(order, 1):
            bad = bool(mask >> LETTERS.index(letter) & 1)
            removed, alone = bad and not gone, mask == 1 << LETTERS.index(letter)
            out[order, step] = tuple(name for name, holds in zip(OUTCOMES, (
                not gone and not bad, removed, bad and gone, alone, removed and good, removed and toxic), strict=True) if holds)
            gone = gone or bad
    return out


@cache
def packed(mask: int, good: bool, toxic: bool) -> int:
    """The counter of one document: field ``600 * outcome + step`` is 1 where the outcome holds."""
    total = 0
    for at, names in enumerate(outcomes(mask, good, toxic).values()):
        for name in names:
            total |= 1 << FIELD_BITS * (STEPS * OUTCOMES.index(name) + at)
    return total


_BYTES = STEPS * len(OUTCOMES) * FIELD_BITS // 8


def unpacked(total: int) -> dict[str, np.ndarray]:
    """Outcome to its counts in the 600 steps, in the order of :data:`ORDERS`."""
    fields = np.frombuffer(total.to_bytes(_BYTES, "little"), "<u8").astype(np.int64).reshape(len(OUTCOMES), STEPS)
    return dict(zip(OUTCOMES, fields, strict=True))


def shapley(removed: np.ndarray) -> np.ndarray:
    """For each step its filter's removals, summed over all orders at any step."""
    letters = np.frombuffer("".join(ORDERS).encode(), np.uint8)
    out = np.zeros(STEPS, np.int64)
    for letter in LETTERS.encode():
        out[letters == letter] = removed[letters == letter].sum()
    return out


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, text_key`` of every row of ``docs``: its part, the
    filters A to D it fails, and the digest of its text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), C.text_or_empty().alias("text"))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        keys = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(map(fails, texts), pa.int32()), pa.array(keys, pa.binary())],
                                          names=["doc_id", "part", "mask", "text_key"])

    return C.map_arrow(rows, fn, "doc_id bigint, part string, mask int, text_key binary", size_of="text")


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: documents by the filters they fail (bit
    0 is A) and their flags, in several rows at most one a text and flag pair."""
    flags = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("l_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = judged(docs)
    rows = rows.join(flags, rows.doc_id == flags.l_id, "left")
    kind = ["text_key", "mask", "part", "good", "toxic"]
    rows = rows.select("doc_id", "text_key", "mask", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # a row of a repeated id is no copy of a smaller id: how many have the least one, in each kind, then of each text
    same = rows.groupBy("doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    groups = same.groupBy(*kind).agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"),
                                     F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    groups = C.stored(groups, "texts")
    first = groups.groupBy("text_key").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("kinds"))
    # the least of a text of one kind is its own
    alone = groups.join(first.where("kinds > 1").select("text_key", "first"), "text_key", "left")
    original = F.coalesce(F.col("least") == F.coalesce("first", "least"), F.lit(False))
    passing = F.col("n_null") + F.when(original, F.col("n_least")).otherwise(0)
    return alone.select("part", "mask", "good", "toxic", F.explode(F.array(
        F.struct(F.lit(0).alias("e"), passing.alias("n")), F.struct(F.lit(1).alias("e"), (F.col("n") - passing).alias("n")))).alias("x")).select(
        "part", (F.col("mask") + 16 * F.col("x.e")).alias("mask"), "good", "toxic", F.col("x.n").alias("n")).where("n > 0")


def _summed(rows: DataFrame, value) -> DataFrame:
    """``part, total``: the integers that ``value`` makes of the rows, added up
    by part in each task; a task that meets many parts hands its sums on before
    it takes up another one, so rows sorted by part give one sum a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            sums = [t.to_bytes(_BYTES, "little") for t in totals.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(sums, pa.binary())], names=["part", "total"])

        for piece in C.slices(batches):
            for part, number in value(piece):
                if part not in totals and len(totals) >= PARTS_AT_ONCE:
                    yield out()
                    totals.clear()
                totals[part] = totals.get(part, 0) + number
        if totals:
            yield out()

    return rows.mapInArrow(run, "part string, total binary")


def _packed_rows(piece: pa.RecordBatch) -> Iterator[tuple[str, int]]:
    columns = [piece.column(c).to_pylist() for c in ("part", "mask", "good", "toxic", "n")]
    return ((part, n * packed(mask, good, toxic)) for part, mask, good, toxic, n in zip(*columns, strict=True))


def _sums(piece: pa.RecordBatch) -> Iterator[tuple[str, int]]:
    return ((part, int.from_bytes(total, "little")) for part, total in zip(piece.column("part").to_pylist(), piece.column("total").to_pylist(), strict=True))


def step_outcomes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the outcome counts, 600 rows a part.

    A part is a ``lang`` value (null: the empty string); a null text is empty.
    Copies count table-wide; a row without id is a copy of nothing, and nothing
    is a copy of it; repeated rows of one id are no copies of each other, and
    each counts.  Of repeated labels any 1 counts.  An empty table has no parts.
    Other columns are not read.
    """
    C.ready(docs.sparkSession)
    totals = _summed(failure_counts(docs, labels), _packed_rows)
    # a part's sums are dealt out, added up, and added up again
    shared = totals.withColumn("share", F.pmod(F.xxhash64("total"), F.lit(SHARES))).repartition("part", "share").drop("share")
    totals = _summed(_summed(shared, _sums).repartition("part").sortWithinPartitions("part"), _sums)
    names = ["part", "filter_order", "step", *OUTCOMES, "shapley"]

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = batch.column("part").to_pylist()
        counts = [unpacked(int.from_bytes(t, "little")) for t in batch.column("total").to_pylist()]
        columns = [pa.array(np.repeat(np.array(parts, object), STEPS), pa.string()),
                   pa.array([o for o in ORDERS for _ in LETTERS] * len(parts), pa.string()), pa.array(list(range(1, 6)) * (len(ORDERS) * len(parts)), pa.int32())]
        columns += [pa.array(np.concatenate([c[name] for c in counts]) if counts else [], pa.int64()) for name in OUTCOMES]
        columns.append(pa.array(np.concatenate([shapley(c["removed"]) for c in counts]) if counts else [], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows = C.map_arrow(totals, fn, "part string, filter_order string, step int, " + ", ".join(f"{n} bigint" for n in names[3:]), size_of="total")
    return rows


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of the five filters over all documents, by language."""
    return step_outcomes(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


_LETTER = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E'))"
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        len(ws) < {MIN_WORDS} AS a, 100 * len(list_distinct(ws)) < {MIN_DISTINCT} * len(ws) AS b,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(t) AS c,
        regexp_matches(t, '[#$%&*|]') AS dd, coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e
      FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
        || (CASE WHEN dd THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS bad, count(*) AS n FROM f GROUP BY ALL),
o AS (SELECT p || q || r || s || u AS filter_order FROM {_LETTER} AS v(p), {_LETTER} AS w(q), {_LETTER} AS x(r), {_LETTER} AS y(s), {_LETTER} AS z(u)
      WHERE len(list_distinct([p, q, r, s, u])) = 5),
st AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, left(filter_order, step - 1) AS before FROM o, unnest(range(1, 6)) AS t(step)),
j AS (SELECT part, filter_order, step, letter, good, toxic, n, contains(bad, letter) AS hit, before <> '' AND regexp_matches(bad, '[' || before || '-]') AS gone, bad = letter AS lone
      FROM m, st),
r AS (SELECT part, filter_order, step, letter,
        CAST(sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN lone THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN hit AND NOT gone THEN n * good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN hit AND NOT gone THEN n * toxic ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM j GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""
