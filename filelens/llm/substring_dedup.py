"""Repeated passages across documents: the earliest occurrence stays, the rest is cut out.

Units are the parts of lines between punctuation marks.  Equal lines and equal
paragraphs are cut into equal units, so a repeated line or paragraph is a run of
repeated units, and so is a passage spliced into the middle of a line, but for
the pieces of a unit at its two ends.  Case (A-Z) and runs of white space do not
count.  Digests of the units are grouped over all documents; of each digest the
earliest occurrence, by id, text hash and place, is never removed.  Of the rest
those are removed that lie in an unbroken run of repeated units with
``MIN_WORDS`` words or more; each keeps its offsets in the original text and the
place of its earliest occurrence.  Adjacent removed units are one span where
their earliest occurrences are adjacent in one text too.

What no unit catches: a passage in which every unit has a changed word, and of a
passage that begins and ends within units the pieces at its ends.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.llm import common as C
from filelens.operators.skew import skew_join

#: Words of a run from which on it is a passage: 50, less what two cut units lose.
MIN_WORDS = 40

# Fixed value: the marks that end a unit.
MARKS = r".!?,;:|\n。！？"
_UNIT = re.compile(rf"[^{MARKS}]*[{MARKS}]+|[^{MARKS}]+")
_SPACE = " \t\n\x0b\x0c\r"

SPAN = "struct<start:bigint,end:bigint,first_doc_id:bigint,first_start:bigint>"


def units(text: str) -> list[tuple[int, int, int, bytes]]:
    """``start, end, words, digest`` of the units of a text that are not blank,
    without the white space around them."""
    out = []
    for m in _UNIT.finditer(text):
        words = m[0].encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
        if words:
            start = m.end() - len(m[0].lstrip(_SPACE))
            out.append((start, m.start() + len(m[0].rstrip(_SPACE)), len(words), xxhash.xxh3_128_digest(b" ".join(words))))
    return out


_UNITS = ("start", "end", "words", "h1", "h2")
_UNIT_TYPES = dict(zip(_UNITS, (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True))


def unit_lists(rows: DataFrame) -> DataFrame:
    """``doc_id, text_key`` and the units of every row of ``doc_id, text`` as
    lists ``start, end, words, h1, h2`` (the last two are the digest)."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [units(t) for t in batch.column("text").to_pylist()]
        flat = [u for us in found for u in us]
        offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        digests = np.frombuffer(b"".join(u[3] for u in flat), np.int64).reshape(-1, 2)
        values = [*([u[k] for u in flat] for k in range(3)), digests[:, 0].copy(), digests[:, 1].copy()]
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in zip(values, _UNIT_TYPES.values(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *lists], names=["doc_id", "text_key", *_UNITS])

    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return C.map_arrow(rows, fn, "doc_id bigint, text_key bigint, start array<int>, end array<int>, words array<int>, h1 array<bigint>, h2 array<bigint>",
                       size_of="text")


def _flat(batch: pa.RecordBatch, columns: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Row and place in its list of each element, and the elements by column."""
    first = batch.column(columns[0])
    sizes = first.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return row, place, {c: batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in columns}


def runs(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of the run that each of these sorted units is in: units of one
    row whose places follow each other."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    return np.cumsum(new) - 1


def _in_long_runs(row: np.ndarray, at: np.ndarray, words: np.ndarray, min_words: int) -> np.ndarray:
    run = runs(row, at)
    return np.bincount(run, words)[run] >= min_words if len(run) else np.zeros(0, bool)


def _chosen(lists: DataFrame, digests: DataFrame, min_words: int | None = None) -> DataFrame:
    """The units whose ``h1`` occurs in ``digests`` (and a few others) as rows
    ``doc_id, text_key, at, start, end, words, h1, h2``; with ``min_words`` only
    those in unbroken runs of so many words."""
    slots = C.Slots(lists.sparkSession, digests, "h1")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, at, unit = _flat(batch, _UNITS)
        keep = np.flatnonzero(slots.hold(unit["h1"]))
        if min_words is not None:
            keep = keep[_in_long_runs(row[keep], at[keep], unit["words"][keep], min_words)]
        rows = pa.array(row[keep], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), batch.column("text_key").take(rows), pa.array(at[keep], pa.int32()),
                                           *[pa.array(unit[c][keep], t) for c, t in _UNIT_TYPES.items()]], names=["doc_id", "text_key", "at", *_UNITS])

    return C.map_arrow(lists, fn, "doc_id bigint, text_key bigint, at int, start int, end int, words int, h1 bigint, h2 bigint", size_of="h1")


def _spans(batch: pa.RecordBatch, min_words: int) -> pa.RecordBatch:
    """``doc_id, text_key, spans, n_units, n_words`` of texts with their
    repeated units ``u`` (structs sorted by place)."""
    names = ("at", "start", "end", "words", "f_id", "f_key", "f_at", "f_start")
    u = batch.column("u")
    sizes = u.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    fields = u.flatten().flatten()
    known = fields[names.index("f_id")].is_valid().to_numpy(zero_copy_only=False)
    unit = {n: f.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for n, f in zip(names, fields, strict=True)}
    single = np.ones(len(row), bool)  # rows of one id and text are one document
    single[1:] = (row[1:] != row[:-1]) | (unit["at"][1:] != unit["at"][:-1])
    row, known, unit = row[single], known[single], {n: v[single] for n, v in unit.items()}
    keep = _in_long_runs(row, unit["at"], unit["words"], min_words)
    row, known, unit = row[keep], known[keep], {n: v[keep] for n, v in unit.items()}
    new = np.ones(len(row), bool)
    same = (known[1:] == known[:-1]) & (unit["f_id"][1:] == unit["f_id"][:-1]) & (unit["f_key"][1:] == unit["f_key"][:-1]) & (unit["f_at"][1:] == unit["f_at"][:-1] + 1)
    new[1:] = np.diff(runs(row, unit["at"])).astype(bool) | ~same
    first, n = np.flatnonzero(new), len(sizes)
    last = np.append(first[1:], len(row)) - 1 if len(first) else first
    offsets = np.append(0, np.cumsum(np.bincount(row[first], minlength=n)))
    span = pa.StructArray.from_arrays([pa.array(unit["start"][first]), pa.array(unit["end"][last]), pa.array(unit["f_id"][first], mask=~known[first]),
                                       pa.array(unit["f_start"][first])], names=["start", "end", "first_doc_id", "first_start"])
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), span),
                                       pa.array(np.bincount(row, minlength=n), pa.int64()),
                                       pa.array(np.bincount(row, unit["words"], minlength=n).astype(np.int64))], names=["doc_id", "text_key", "spans", "n_units", "n_words"])


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_key, spans, n_units, n_words`` of every text that repeats a
    passage: ``start, end, first_doc_id, first_start`` of each span to remove,
    and how many units and words they hold.

    ``docs`` has ``doc_id bigint, text string``, no null text.  A null id comes
    first; rows with the same id and text are one document, rows with the same
    id and another text are documents of their own; a text may repeat itself.
    """
    lists = C.stored(unit_lists(docs), "units")
    often = lists.select(F.explode("h1").alias("h1")).groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1")
    # no unit outside a run of units that occur twice is removed; but any occurrence may be the earliest
    rows = C.stored(_chosen(lists, C.stored(often, "often"), min_words), "candidates")
    place = F.struct("doc_id", "text_key", "at", "start")
    first = _chosen(lists, rows.select("h1").distinct()).groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # what slipped through the bitmap, or stands in copies of its own row only, is its own first
    first = first.where(~F.col("first").eqNullSafe(F.col("last"))).select(
        "h1", "h2", F.col("first.doc_id").alias("f_id"), F.col("first.text_key").alias("f_key"), F.col("first.at").alias("f_at"), F.col("first.start").alias("f_start"))
    again = skew_join(rows, C.stored(first, "firsts"), ["h1", "h2"])
    same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_key") == F.col("f_key")) & (F.col("at") == F.col("f_at"))
    unit = F.struct("at", "start", "end", "words", "f_id", "f_key", "f_at", "f_start")
    texts = again.where(~same).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(unit)).alias("u"))
    out = C.map_arrow(texts, lambda b: _spans(b, min_words), f"doc_id bigint, text_key bigint, spans array<{SPAN}>, n_units bigint, n_words bigint", size_of="u")
    return out.where(F.size("spans") > 0)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans (ascending, disjoint).  The white space
    between two spans that follow each other goes with them."""
    out, at = [], 0
    for start, end in spans:
        between = text[at:start]
        if at == 0 or between.strip(_SPACE):
            out.append(between)
        at = end
    return "".join(out) + text[at:]


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, and
    ``removed_spans`` (``start, end, first_doc_id, first_start`` in the original
    text), ``removed_units``, ``removed_words``; every row stays.

    A null text stays null and holds nothing; other columns pass as they are,
    but those three names are refused.  An empty table gives an empty one.
    """
    added = ("removed_spans", "removed_units", "removed_words")
    C.refuse(docs, *added)
    C.ready(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), C.text_or_empty().alias("text"))
    found = C.stored(repeated_passages(plain, min_words), "passages")
    i, k, d_id, d_key = (C.tag(x) for x in ("i", "k", "id", "key"))
    found = found.select(F.col("doc_id").alias(d_id), F.col("text_key").alias(d_key), *[F.col(a).alias(b) for a, b in zip(("spans", "n_units", "n_words"), added, strict=True)])
    keyed = docs.withColumn(i, F.col("doc_id").cast("bigint")).withColumn(k, F.xxhash64(C.text_or_empty()))
    maybe, rest = C.split_by(keyed, found.select(F.col(d_id).alias(i), F.col(d_key).alias(k)), i, k)
    maybe = maybe.join(found, maybe[i].eqNullSafe(F.col(d_id)) & (maybe[k] == F.col(d_key)), "left").drop(i, k, d_id, d_key)
    none = {"removed_spans": F.array().cast(f"array<{SPAN}>"), "removed_units": F.lit(0).cast("bigint"), "removed_words": F.lit(0).cast("bigint")}
    maybe = maybe.select(*docs.columns, *[F.coalesce(F.col(c), none[c]).alias(c) for c in added])
    rest = rest.select(*docs.columns, *[none[c].alias(c) for c in added])
    at = maybe.columns.index("text")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [cut(t, [(s["start"], s["end"]) for s in spans]) if spans else t
                 for t, spans in zip(batch.column("text").to_pylist(), batch.column("removed_spans").to_pylist(), strict=True)]
        return batch.set_column(at, "text", pa.array(texts, pa.string()))

    maybe = maybe.withColumn("text", F.col("text").cast("string"))
    return C.map_arrow(maybe, fn, maybe.schema, size_of="text").unionByName(rest.withColumn("text", F.col("text").cast("string")))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages that an earlier one, or an earlier
    place in them, holds; ``removed`` lists start:end:first_doc_id:first_start."""
    out = without_repeats(C.table(spark, sf_dir, "documents"))
    removed = F.array_join(F.transform("removed_spans", lambda s: F.concat_ws(":", s["start"], s["end"], F.coalesce(s["first_doc_id"].cast("string"), F.lit("")), s["first_start"])), ",")
    return out.select("doc_id", "text", F.size("removed_spans").cast("bigint").alias("n_removed"), "removed_words", removed.alias("removed"))


SQL = rf"""
WITH u AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^{MARKS}]*[{MARKS}]+|[^{MARKS}]+')) AS raw,
             generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^{MARKS}]*[{MARKS}]+|[^{MARKS}]+'), 1) AS i FROM documents),
o AS (SELECT *, coalesce(sum(length(raw)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o,
        regexp_extract_all(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM u),
b AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos, array_to_string(ws, ' ') AS plain, len(ws) AS words,
        CAST(o + length(raw) - length(regexp_replace(raw, '^[\x20\x09-\x0D]+', '')) AS BIGINT) AS s, CAST(o + length(regexp_replace(raw, '[\x20\x09-\x0D]+$', '')) AS BIGINT) AS e
      FROM o WHERE len(ws) > 0),
f AS (SELECT *, first_value(doc_id) OVER w AS f_id, first_value(pos) OVER w AS f_pos, first_value(s) OVER w AS f_s FROM b WINDOW w AS (PARTITION BY plain ORDER BY doc_id, pos)),
r AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM f WHERE doc_id <> f_id OR pos <> f_pos),
g AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, run) AS total, CASE WHEN lag(f_id) OVER w = f_id AND lag(f_pos) OVER w = f_pos - 1 THEN 0 ELSE 1 END AS fresh
      FROM r WINDOW w AS (PARTITION BY doc_id, run ORDER BY pos)),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM g WHERE total >= {MIN_WORDS}),
sp AS (SELECT doc_id, span, min(s) AS s, max(e) AS e, first(f_id ORDER BY pos) AS f_id, first(f_s ORDER BY pos) AS f_s, CAST(sum(words) AS BIGINT) AS words FROM k GROUP BY ALL),
pc AS (SELECT sp.*, coalesce(lag(e) OVER (PARTITION BY sp.doc_id ORDER BY s), 0) AS prev, d.text FROM sp JOIN documents d ON d.doc_id = sp.doc_id),
kept AS (SELECT *, CASE WHEN prev = 0 OR regexp_matches(substr(text, prev + 1, s - prev), '[^\x20\x09-\x0D]') THEN substr(text, prev + 1, s - prev) ELSE '' END AS piece FROM pc),
t AS (SELECT doc_id, string_agg(piece, '' ORDER BY s) AS head, max(e) AS last, count(*) AS n_removed, CAST(sum(words) AS BIGINT) AS removed_words,
        string_agg(s || ':' || e || ':' || f_id || ':' || f_s, ',' ORDER BY s) AS removed FROM kept GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN t.doc_id IS NULL THEN d.text ELSE head || substr(d.text, last + 1) END AS text, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_words, 0) AS removed_words, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id
"""
