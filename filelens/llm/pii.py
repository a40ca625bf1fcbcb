"""Personal data: fixed patterns, and terms that give protected entities away.

The patterns find e-mail addresses, IP addresses, card and phone numbers: the
protected entities.  How strongly a term reveals an entity is estimated from
the corpus: over all lines of all documents, the pointwise mutual information
of term and entity is held against the information content of the entity,

    PMI(t; e) / IC(e) = 1 - log(n(t) / n(t, e)) / log(N / n(e)),

which is 1 where the term occurs only beside the entity (it tells as much as
the entity itself) and near 0 for a common word.  Terms on a line with an entity that
pass the disclosure threshold are sensitive as well, unless chance explains
them: by chance a term and an entity meet in about m = n(t) n(e) / N contexts,
and in k or more with a probability of at most exp(k - m) (m / k)^k (Chernoff's
bound), which, times the pairs rated, has to stay below ``CHANCE``.  They are
removed wherever they stand in a document that holds the entity, the entities
are generalised to their kind.

Counts cover the whole corpus: a task adds up the lines of all its words and
hands them on at a fixed number of distinct ones, so the counted rows grow with
the text; the terms seen beside entities are picked from the sums.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.llm import common as C

KINDS = ("email", "ip", "card", "phone", "term")
#: Pairs expected to pass by chance among all pairs rated.
CHANCE = 0.01
#: Share of an entity's information that a term may reveal.
DISCLOSURE = 0.9
#: Distinct words that a task counts before it hands them on.
WORDS_AT_ONCE = 400_000
REPLACEMENT = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": ""}

# The four patterns; the e-mail one is applied from its "@" on.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
# (the address one starts at a run of digits and gives no digit back: same matches, linear time)
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+")

_LOCAL_SET = frozenset(_LOCAL)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _octet(part: str) -> bool:
    """At most 255; leading zeros do not count."""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) < 256


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches: the longest run of local-part
    characters before an ``@`` that a domain follows."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_SET:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of the pattern matches, by start, then kind as listed."""
    found = [(a, b, 0) for a, b in _emails(text)]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda s: (s[0], s[2]))]


def _stretches(spans: list[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the spans as disjoint stretches of text."""
    starts, ends = [], []
    for a, b, _ in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _words(text: str, left: int, right: int, starts: list[int], ends: list[int]) -> list[re.Match[str]]:
    """Words between two places outside all stretches: the last stretch that
    begins before the word's end is over when the word begins."""
    return [m for m in _WORD.finditer(text, left, right) if (i := bisect_left(starts, m.end())) == 0 or ends[i - 1] <= m.start()]


def contexts(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[list[str], list[str], int]]:
    """``entities, terms, context`` of each line with entities: the words are
    those outside all spans; ``context`` is a hash of them, the same for copies
    of the line."""
    out: list[tuple[set[str], list[str], int]] = []
    starts, ends = _stretches(spans)
    line_end = -1
    for a, b, kind in spans:
        if a > line_end:
            left, line_end = text.rfind("\n", 0, a) + 1, text.find("\n", b)
            line_end = len(text) if line_end < 0 else line_end
            words = [m[0].lower() for m in _words(text, left, line_end, starts, ends)]
            out.append((set(), sorted(set(words)), xxhash.xxh64_intdigest(" ".join(words)) >> 1))
        out[-1][0].add(f"{kind}:{text[a:b].lower()}")
    return [(sorted(entities), terms, context) for entities, terms, context in out]


def term_spans(text: str, spans: list[tuple[int, int, str]], terms: set[str]) -> list[tuple[int, int]]:
    """``start, end`` of every occurrence of ``terms`` outside the spans."""
    return [(m.start(), m.end()) for m in _words(text, 0, len(text), *_stretches(spans)) if m[0].lower() in terms]


def entity_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, lines, spans, near`` of every row of ``doc_id, text``:
    the pattern matches and the words of their lines."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        spans = [base_spans(t) for t in texts]
        near = [contexts(t, s) if s else [] for t, s in zip(texts, spans, strict=True)]
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        near_type = pa.list_(pa.struct([("entities", pa.list_(pa.string())), ("terms", pa.list_(pa.string())), ("context", pa.int64())]))
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("text_key"), pa.array([t.count("\n") + 1 for t in texts], pa.int64()),
            pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in s] for s in spans], span_type),
            pa.array([[dict(zip(("entities", "terms", "context"), n, strict=True)) for n in ns] for ns in near], near_type),
        ], names=["doc_id", "text_key", "lines", "spans", "near"])

    return C.map_arrow(rows, fn, "doc_id bigint, text_key bigint, lines bigint, spans array<struct<start:bigint,end:bigint,kind:string>>, "
                       "near array<struct<entities:array<string>,terms:array<string>,context:bigint>>", size_of="text")


def _line_counts(docs: DataFrame) -> DataFrame:
    """``term, n``: lines of the corpus that hold each word, added up by task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

        for piece in C.slices(batches, "text"):
            for text in piece.column("text").to_pylist():
                for line in text.lower().split("\n"):
                    seen.update(set(_WORD.findall(line)))
                    if len(seen) > WORDS_AT_ONCE:
                        yield out()
                        seen.clear()
        yield out()

    return docs.select("text").mapInArrow(count, "term string, n bigint")


def term_lines(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n_term``: lines of ``docs`` that hold each term of ``terms``."""
    C.ready(docs.sparkSession)
    summed = _line_counts(docs).groupBy("term").agg(F.sum("n").alias("n_term"))
    return summed.join(terms.select("term").distinct(), "term")


def _surprise(k: F.Column, m: F.Column) -> F.Column:
    """Bound of -log of the chance of ``k`` or more where ``m`` are expected."""
    return F.when(k > m, k * F.log(k / m) - k + m).otherwise(0.0)


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``entity, term, disclosure`` of the terms over the threshold, chance ruled out."""
    lines = found.select(F.explode("near").alias("x")).select(F.explode("x.entities").alias("entity"), "x.terms", "x.context")
    entities = lines.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = lines.select("entity", F.explode("terms").alias("term"), "context").groupBy("entity", "term").agg(
        F.count_distinct("context").alias("support"), F.count(F.lit(1)).alias("n_both"))
    pairs = C.stored(pairs, "pairs")
    n = int(found.agg(F.sum("lines")).first()[0] or 1)
    least = math.log(max(pairs.count(), 1) / CHANCE)
    # a term is in as many lines as it shares with the entity, or more: pairs that fail with so few fail with its count
    rated = pairs.join(entities, "entity").where(_surprise(F.col("support"), F.col("n_both") * F.col("n_entity") / n) >= least)
    rated = C.stored(rated, "rated")
    rated = rated.join(term_lines(docs, rated), "term")
    told = 1 - F.log(F.greatest(F.col("n_term") / F.col("n_both"), F.lit(1.0))) / F.log(F.lit(float(max(n, 2))) / F.col("n_entity"))
    sure = _surprise(F.col("support"), F.col("n_term") * F.col("n_entity") / n) >= least
    return rated.where((F.col("n_entity") < n) & sure).withColumn("disclosure", told).where(F.col("disclosure") >= DISCLOSURE).select(
        "entity", "term", "disclosure")


def _marked(docs: DataFrame, found: DataFrame, told: DataFrame) -> DataFrame:
    """``e_id, e_key, extra``: all occurrences of the disclosing terms in the
    documents that hold their entities."""
    holds = found.select("doc_id", "text_key", F.explode("near").alias("x")).select(
        "doc_id", "text_key", F.explode("x.entities").alias("entity")).distinct()
    terms = holds.join(told, "entity").groupBy("doc_id", "text_key").agg(F.collect_set("term").alias("terms"))
    terms = C.stored(terms, "told").select(F.col("doc_id").alias("e_id"), F.col("text_key").alias("e_key"), "terms")
    texts = docs.select(F.col("doc_id").alias("e_id"), F.xxhash64("text").alias("e_key"), "text")
    texts = C.prefiltered(texts, terms, "e_id", "e_key").alias("d")
    same = F.col("d.e_id").eqNullSafe(F.col("t.e_id")) & (F.col("d.e_key") == F.col("t.e_key"))
    texts = texts.join(terms.alias("t"), same).select("d.e_id", "d.e_key", "d.text", "t.terms")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        extra = [[{"start": a, "end": b, "kind": "term"} for a, b in term_spans(t, base_spans(t), set(ts))]
                 for t, ts in zip(batch.column("text").to_pylist(), batch.column("terms").to_pylist(), strict=True)]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        return pa.RecordBatch.from_arrays([batch.column("e_id"), batch.column("e_key"), pa.array(extra, kind)], names=["e_id", "e_key", "extra"])

    return C.map_arrow(texts, fn, "e_id bigint, e_key bigint, extra array<struct<start:bigint,end:bigint,kind:string>>",
                       size_of="text").dropDuplicates(["e_id", "e_key"])


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans`` of every row of ``docs``: ``start, end, kind``
    (code points, end exclusive) by start, then kind as listed.

    Kinds are those of the patterns and ``term``.  A null text is empty and
    has no spans; every input row gives one row; rows with the same id and
    text have the same spans.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), C.text_or_empty().alias("text"))
    found = C.stored(entity_spans(docs), "entities")
    told = disclosing_terms(docs, found)
    extra = _marked(docs, found, told)
    out = found.join(extra, found.doc_id.eqNullSafe(F.col("e_id")) & (found.text_key == F.col("e_key")), "left")
    spans = F.concat("spans", F.coalesce("extra", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")))
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("at"), s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return out.select("doc_id", "text_key", ordered.alias("spans"))


def replaced(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with entities generalised to their kind and terms removed;
    overlapping spans go as one, under the kind of the first."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))):
        if start >= at:
            out += [text[at:start], REPLACEMENT[kind]]
        at = max(at, end)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; every row stays.

    A null text stays null; other columns pass as they are.
    """
    spans = find_spans(docs).where(F.size("spans") > 0).distinct()
    k, t, s_id, s_key = (C.tag(x) for x in ("k", "t", "id", "key"))
    touched = spans.select(F.col("doc_id").alias(s_id), F.col("text_key").alias(s_key), F.col("spans").alias(k))
    rows = docs.withColumn(t, F.xxhash64(C.text_or_empty()))
    joined = rows.join(touched, rows["doc_id"].cast("bigint").eqNullSafe(F.col(s_id)) & (rows[t] == F.col(s_key)), "left").drop(s_id, s_key, t)
    names, schema = docs.columns, docs.schema
    at = names.index("text")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [
            replaced(x, [(s["start"], s["end"], s["kind"]) for s in found]) if found and x else x
            for x, found in zip(batch.column("text").to_pylist(), batch.column(k).to_pylist(), strict=True)]
        arrays = [batch.column(c) for c in names]
        arrays[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return C.map_arrow(joined, fn, schema, size_of="text")


def _joined(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> F.Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    found = find_spans(C.table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    counts = [_count(k).alias(f"n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
