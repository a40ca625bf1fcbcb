"""Benchmark decontamination by winnowing, on DataFrame functions alone.

A span of ``m`` words that a document shares with a benchmark item holds
``m - k + 1`` k-grams; the least k-gram hash of every ``m - k + 1`` consecutive
ones is kept, so any shared span of ``m`` words or more shares a kept hash.
The kept hashes of the documents meet all k-gram hashes of the items.  A hit
is then extended to the spans of ``m`` words around it and each of them is
compared word by word with the items' windows.

Hashes of neighbouring words are combined by doubling (1, 2, 4 ... words) with
``zip_with``, and window minima in the same way, so a text costs a few array
passes and no row per word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filelens.llm import common as C
from filelens.session import ensure_checkpoint_dir

WINDOW = 13
#: A document is contaminated when this many times its hit words reach its words.
SHARE = 20
#: Kept hashes of a text up to which each k-gram is looked up one by one; beyond, by bisection in this many steps.
FEW_LOWS, LOG_LOWS = 64, 30
#: What a word is, and the letters that are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: F.Column) -> F.Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _doubled(df: DataFrame, base: str, width: int, combine, out: str) -> DataFrame:
    """Column ``out``: for each place of array ``base``, ``width`` neighbours from
    there combined; places nearer than that to the end hold nothing of use."""
    def ahead(col: str, by: int) -> F.Column:
        return F.slice(col, F.lit(by + 1), F.greatest(F.size(col) - by, F.lit(0)))

    power, have, done, at = base, 1, None, 0
    left = width
    while left:
        if left & 1:
            if done is None:
                done = power
            else:
                name = C.tag("sum")
                df = df.withColumn(name, F.zip_with(done, ahead(power, at), combine))
                done = name
            at += have
        left >>= 1
        if left:
            name = C.tag("pow")
            df = df.withColumn(name, F.zip_with(power, ahead(power, have), combine))
            power, have = name, 2 * have
    return df.withColumn(out, F.col(done))


def _gram_width(m: int) -> int:
    return (m + 1) // 2


def _with_grams(df: DataFrame, m: int, out: str) -> DataFrame:
    """Hashes of the k-grams (of window length ``m``) of array ``words``."""
    ones, raw = C.tag("ones"), C.tag("raw")
    k = _gram_width(m)
    keep = df.columns
    df = df.withColumn(ones, F.transform("words", lambda w: F.xxhash64(w)))
    df = _doubled(df, ones, k, lambda a, b: F.xxhash64(a, b), raw)
    return df.select(*keep, F.slice(raw, F.lit(1), F.greatest(F.size("words") - (k - 1), F.lit(0))).alias(out))


def _with_winnowed(df: DataFrame, m: int, out: str) -> DataFrame:
    """The distinct least k-gram hashes of all windows of ``m`` words."""
    grams, low = C.tag("grams"), C.tag("low")
    keep = df.columns
    df = _doubled(_with_grams(df, m, grams), grams, m - _gram_width(m) + 1, lambda a, b: F.least(a, b), low)
    return df.select(*keep, F.array_distinct(F.slice(low, F.lit(1), F.greatest(F.size("words") - (m - 1), F.lit(0)))).alias(out))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, m, span``: the distinct windows of each item as text; an item
    of fewer words than ``window``, but not none, is one window."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("m", F.least(F.size("words"), F.lit(window)))
    spans = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1),
                        lambda i: F.array_join(F.slice("words", i, F.col("m")), " "))
    return items.select("item_id", "m", F.explode(F.array_distinct(spans)).alias("span"))


def contaminated_words(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, n_items, items`` of every row of ``docs``.

    A word is hit when it lies in an occurrence of a window of an item;
    ``items`` lists the ids of the items with occurring windows, sorted as
    strings.  A null or empty text has no words and no hits; an empty
    benchmark hits nothing; repeated rows are judged alike, rows that share an
    id but not the text each by their own text; an item without id marks words
    but is not listed, a repeated item counts once.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    windows = C.stored(benchmark_windows(benchmark, window), "windows")
    lengths = sorted(r.m for r in windows.select("m").distinct().collect())  # at most `window` numbers

    # what the documents keep, and the items' k-grams
    kept = docs.select("doc_id", "text_key", words_of(F.col("text")).alias("words"))
    for m in lengths:
        kept = _with_winnowed(kept, m, f"low_{m}")
    kept = C.stored(kept.withColumn("n_words", F.size("words").cast("bigint")).drop("words"), "winnowed")
    hits = None
    for m in lengths:
        spans = windows.where(F.col("m") == m).select(F.split("span", " ").alias("words"))
        grams = C.stored(_with_grams(spans, m, "grams").select(F.explode("grams").alias("low")).distinct(), "grams")
        seeds = kept.select("doc_id", "text_key", F.explode(f"low_{m}").alias("low")).join(grams, "low", "left_semi")
        seeds = C.stored(seeds.groupBy("doc_id", "text_key").agg(F.collect_set("low").alias("lows")), "seeds")
        found = _extended(docs, seeds, windows.where(F.col("m") == m), m)
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return kept.select("doc_id", "text_key", "n_words", F.lit(0).cast("bigint").alias("n_hit"), F.lit(0).cast("bigint").alias("n_items"),
                           F.array().cast("array<string>").alias("items"))
    hits = C.stored(hits, "hits")
    key = ["doc_id", "text_key"]
    order = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ends = hits.groupBy(*key, "start").agg((F.col("start") + F.max("m")).alias("end"))
    new = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(order), F.col("start")))
    counted = ends.withColumn("new", F.greatest(new, F.lit(0))).groupBy(*key).agg(F.sum("new").alias("n_hit"))
    listed = hits.where("item_id is not null").select(*key, F.col("item_id").cast("string").alias("item")).distinct()
    listed = listed.groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items"))

    counted = counted.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "n_hit")
    listed = listed.select(F.col("doc_id").alias("l_id"), F.col("text_key").alias("l_key"), "items")
    out = kept.drop(*[f"low_{m}" for m in lengths])
    out = out.join(counted, out.doc_id.eqNullSafe(F.col("c_id")) & (out.text_key == F.col("c_key")), "left")
    out = out.join(listed, out.doc_id.eqNullSafe(F.col("l_id")) & (out.text_key == F.col("l_key")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.size(items).cast("bigint").alias("n_items"), items.alias("items"))


def _found_in(values: str, sorted_: str) -> F.Column:
    """For each element of array ``values`` whether the sorted array holds it:
    bisection, all elements one step at a time."""
    def ahead(step: int):
        def moved(p: F.Column, v: F.Column) -> F.Column:
            fits = (p + step <= F.size(sorted_)) & (F.try_element_at(sorted_, p + step) <= v)
            return F.when(fits, p + step).otherwise(p)

        return moved

    at = F.transform(values, lambda v: F.lit(0))
    for k in range(LOG_LOWS - 1, -1, -1):
        at = F.zip_with(at, values, ahead(1 << k))
    return F.zip_with(at, values, lambda p, v: (p > 0) & F.coalesce(F.try_element_at(sorted_, F.greatest(p, F.lit(1))) == v, F.lit(False)))


def _extended(docs: DataFrame, seeds: DataFrame, windows: DataFrame, m: int) -> DataFrame:
    """Windows of ``m`` words around the seeds that are, word by word, windows
    of an item: ``doc_id, text_key, start, m, item_id``."""
    right = seeds.select(F.col("doc_id").alias("s_id"), F.col("text_key").alias("s_key"), "lows")
    found = C.prefiltered(docs, seeds, "doc_id", "text_key").dropDuplicates(["doc_id", "text_key"]).join(right, docs.doc_id.eqNullSafe(right.s_id) & (docs.text_key == right.s_key))
    found = found.select("doc_id", "text_key", "lows", words_of(F.col("text")).alias("words"))
    found = _with_grams(found, m, "grams").withColumn("sorted", F.sort_array("lows"))
    few = F.transform("grams", lambda g, i: F.when(F.array_contains("lows", g), i))
    places = F.when(F.size("lows") <= FEW_LOWS, few).otherwise(F.transform(_found_in("grams", "sorted"), lambda hit, i: F.when(hit, i)))
    found = found.withColumn("places", F.filter(places, lambda p: p.isNotNull()))
    around = F.transform("places", lambda p: F.sequence(F.greatest(p - (m - _gram_width(m)), F.lit(0)),
                                                        F.least(p, F.size("words") - m)))
    found = found.withColumn("starts", F.array_distinct(F.flatten(around)))
    spans = F.transform("starts", lambda s: F.struct(s.alias("start"), F.array_join(F.slice("words", s + 1, m), " ").alias("span")))
    found = found.select("doc_id", "text_key", F.explode(spans).alias("s")).select("doc_id", "text_key", "s.start", "s.span")
    return found.join(windows, "span").select("doc_id", "text_key", "start", "m", "item_id")


def is_contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    judged = contaminated_words(docs, benchmark).where(is_contaminated())
    k, c_id, c_key = C.tag("k"), C.tag("id"), C.tag("key")
    bad = judged.select(F.col("doc_id").alias(c_id), F.col("text_key").alias(c_key)).distinct()
    keyed = docs.withColumn(k, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(F.col(c_id)) & (keyed[k] == F.col(c_key)), "left_anti").drop(k)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document against every benchmark item."""
    out = contaminated_words(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      is_contaminated().alias("contaminated"))


SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS m, array_to_string(ws[i : i + least(len(ws), {WINDOW}) - 1], ' ') AS w
       FROM b, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) AS t(i) WHERE len(ws) > 0),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, i, array_to_string(ws[i : i + m - 1], ' ') AS w
       FROM d CROSS JOIN ms, unnest(range(1, len(ws) - m + 2)) AS t(i)),
hit AS (SELECT DISTINCT doc_id, m, i, item_id FROM dw JOIN bw USING (m, w)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + m)) AS t(p) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""
