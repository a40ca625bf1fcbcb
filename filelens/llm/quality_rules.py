"""Quality rules whose cutoffs are certified on labelled documents, on DataFrame functions alone.

Signals of a text (symbols a word, repeated words, long or short words, repeated
lines) reject it beyond a cutoff.  Which cutoffs hold is decided for each
stratum (language) by the labelled documents of good quality, a holdout on which
nothing is fitted.  A cutoff is certified when its false rejections are so few
that a risk of more than ``RISK`` a signal would hardly give them: the exact
binomial probability of as few or fewer is at most the error allowed.  The
error is divided among all (stratum, signal) pairs; within a pair the cutoffs
are tested from the mildest to the strictest, and the first that fails ends the
pair's tests, so with probability ``1 - ERROR`` all certified cutoffs hold at
once, and the signals of a stratum together reject at most
``RISK * len(SIGNALS)`` of its good documents.

Among the certified cutoffs of a pair the one is taken that rejects most poor
documents, each good one counting for ``PRICE`` poor ones; where none gains
anything, or too few labels certify it, the signal rejects nothing.  Cutoffs are
integer fractions, so no verdict hangs on rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filelens.llm import common as C
from filelens.session import ensure_checkpoint_dir

#: Share of good documents that one signal may reject, at the certainty 1 - ERROR for all together.
RISK = 0.02
ERROR = 0.05
#: Poor documents that one lost good document outweighs.
PRICE = 10
#: Base rule: fewer words, or a greater percentage of repeated ones, fail.
MIN_WORDS, MAX_REPEATED = 50, 50

# White space, words and symbols.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
SYMBOLS = r"[#*$%&|<>]"

#: Signal: numerator, denominator, direction (1: too much, -1: too little), and
#: the cutoffs in thousandths, mildest first.
SIGNALS: dict[str, tuple[str, str, int, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "n_words", 1, (2000, 1000, 500, 200, 100, 50, 20, 10)),
    "repeats": ("n_repeat_words", "n_words", 1, (450, 400, 350, 300, 250, 200, 150, 100)),
    "lines": ("n_dup_lines", "n_lines", 1, (800, 700, 600, 500, 400, 300, 200, 100)),
    "long_words": ("word_chars", "n_words", 1, (12000, 10000, 9000, 8000, 7500, 7000, 6500, 6000)),
    "short_words": ("word_chars", "n_words", -1, (2000, 2500, 3000, 3500, 3800, 4000, 4200, 4400)),
}


def _ahead(col: str, by: int = 1) -> F.Column:
    return F.slice(col, F.lit(by + 1), F.greatest(F.size(col) - by, F.lit(0)))


def text_signals(docs: DataFrame) -> DataFrame:
    """``doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_lines,
    n_repeat_words`` of every row of ``docs`` (a null text has none).

    Repeated windows of three words are found by their hashes, sorted within
    the text, and compared word by word; the rows cost a few array passes, and
    a text without equal hashes is not sorted.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"), C.text_or_empty().alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")))
    rows = rows.withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("pairs", F.zip_with("ones", _ahead("ones"), lambda a, b: F.xxhash64(a, b)))
    # the last two have no window
    rows = rows.withColumn("hashes", F.slice(F.zip_with("pairs", _ahead("ones", 2), lambda a, b: F.xxhash64(a, b)),
                                             F.lit(1), F.greatest(F.size("ones") - 2, F.lit(0))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    placed = F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
    rows = rows.withColumn("sorted", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed).otherwise(none))
    alike = F.zip_with("sorted", _ahead("sorted"), lambda a, b: F.coalesce(
        (a["h"] == b["h"]) & (F.slice("words", a["i"], F.lit(3)) == F.slice("words", b["i"], F.lit(3))), F.lit(False)))
    rows = rows.withColumn("alike", alike)
    twice = F.zip_with("alike", F.concat(F.array(F.lit(False)), "alike"), lambda a, b: a | b)
    starts = F.filter(F.zip_with("sorted", twice, lambda s, t: F.when(t, s["i"])), lambda i: i.isNotNull())
    rows = rows.withColumn("starts", F.sort_array(starts))
    covered = F.aggregate(F.zip_with("starts", _ahead("starts"), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))), F.lit(0), lambda s, x: s + x)
    return rows.select(
        "doc_id", "stratum", F.size("words").cast("bigint").alias("n_words"), F.char_length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), F.size("lines").cast("bigint").alias("n_lines"),
        covered.cast("bigint").alias("n_repeat_words"))


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def rejects(signal: str, cutoff: F.Column | int) -> F.Column:
    """Whether a signal lies beyond a cutoff (thousandths)."""
    top, bottom, way, _ = SIGNALS[signal]
    cutoff = cutoff if isinstance(cutoff, F.Column) else F.lit(cutoff)
    value, limit = 1000 * F.col(top), cutoff * F.col(bottom)
    return value > limit if way > 0 else value < limit


def binomial_tail(n: F.Column, k: F.Column, risk: float) -> F.Column:
    """Probability of ``k`` or fewer events in ``n`` tries of chance ``risk``.

    The terms are added as logarithms from the first on (``k`` steps), so that
    none vanishes for large ``n``; more than the expected number is answered
    with 1 without counting (the probability is then above any error allowed).
    """
    odds = F.log(F.lit(risk / (1 - risk)))
    first = n * F.log(F.lit(1 - risk))
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(acc: F.Column, i: F.Column) -> F.Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        top, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (top + F.log1p(F.exp(low - top))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.exp(F.aggregate(steps, start, step)["total"])
    return F.when(k > n * risk, F.lit(1.0)).otherwise(tail)


def certified_cutoffs(signals: DataFrame, labels: DataFrame) -> DataFrame:
    """``stratum, signal, cutoff, n_good, lost, caught, tail`` of the cutoff taken
    for each stratum and signal that has one.

    Holdout: the documents with a label that the base rules leave.  Repeated
    labels of an id count once, as good if any of them is.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("l_id")).agg(F.max(F.col("quality") == 1).alias("good"))
    held = signals.where(~base_failed()).join(known, F.col("doc_id") == F.col("l_id"))
    good, poor = F.col("good"), ~F.col("good")
    counts = [F.count_if(good & rejects(s, c)).alias(f"lost_{s}_{c}") for s, spec in SIGNALS.items() for c in spec[3]]
    counts += [F.count_if(poor & rejects(s, c)).alias(f"caught_{s}_{c}") for s, spec in SIGNALS.items() for c in spec[3]]
    counted = held.groupBy("stratum").agg(F.count_if(good).alias("n_good"), *counts)
    tests = [F.struct(F.lit(s).alias("signal"), F.lit(at).alias("at"), F.lit(c).alias("cutoff"), F.col(f"lost_{s}_{c}").alias("lost"), F.col(f"caught_{s}_{c}").alias("caught"))
             for s, spec in SIGNALS.items() for at, c in enumerate(spec[3])]
    tested = C.stored(counted.select("stratum", "n_good", F.explode(F.array(*tests)).alias("t")).select("stratum", "n_good", "t.*"), "tests")
    # the error allowed is divided among all pairs of stratum and signal
    pairs = tested.agg(F.greatest(F.count_distinct("stratum") * len(SIGNALS), F.lit(1)).alias("pairs"))
    tested = tested.crossJoin(F.broadcast(pairs)).withColumn("tail", binomial_tail(F.col("n_good"), F.col("lost"), RISK))
    order = Window.partitionBy("stratum", "signal").orderBy("at")
    holds = F.min(F.col("tail") <= ERROR / F.col("pairs")).over(order)
    gain = F.col("caught") - PRICE * F.col("lost")
    best = F.row_number().over(Window.partitionBy("stratum", "signal").orderBy(F.col("gain").desc(), "at"))
    tested = tested.withColumn("holds", holds).where("holds").withColumn("gain", gain).where("gain > 0").withColumn("rank", best).where("rank = 1")
    return tested.select("stratum", "signal", "cutoff", "n_good", "lost", "caught", "tail")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, stratum``, the signals, ``base_failed`` and ``kept`` of every
    row of ``docs``.

    A null or empty text has no words and fails the base rules; a null ``lang``
    is the stratum of the empty string; a stratum without enough labels is
    judged by the base rules alone; repeated rows are judged alike, each by its
    own text; an empty table gives no rows; other columns are not read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    signals = C.stored(text_signals(docs), "signals")
    chosen = certified_cutoffs(signals, labels).groupBy(F.col("stratum").alias("of")).pivot("signal", list(SIGNALS)).agg(F.first("cutoff"))
    rows = signals.join(chosen, F.col("stratum") == F.col("of"), "left")
    bad = base_failed()
    for signal in SIGNALS:
        bad = bad | F.coalesce(rejects(signal, F.col(signal)), F.lit(False))
    return rows.select(*signals.columns, base_failed().alias("base_failed"), (~bad).alias("kept"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals and verdicts of all documents."""
    out = judged(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _beyond(top: str, bottom: str, way: int, cutoff: str) -> str:
    return f"1000 * {top} {'>' if way > 0 else '<'} {cutoff} * {bottom}"


_CUTS = ", ".join(f"('{s}', {at}, {c})" for s, spec in SIGNALS.items() for at, c in enumerate(spec[3]))
_TEST = " ".join(f"WHEN '{s}' THEN {_beyond(*spec[:3], 'cutoff')}" for s, spec in SIGNALS.items())
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS ls FROM d),
tri AS (SELECT doc_id, i, ws[i : i + 2] AS g FROM d, unnest(range(1, len(ws) - 1)) AS u(i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM rep, unnest([i, i + 1, i + 2]) AS u(p) GROUP BY doc_id),
s AS (SELECT d.doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN ln ON ln.doc_id = d.doc_id LEFT JOIN cov ON cov.doc_id = d.doc_id),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM s),
lab AS (SELECT doc_id, max(quality = 1) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT b.*, good FROM b JOIN lab ON lab.doc_id = b.doc_id WHERE NOT base_failed),
cuts(signal, pos, cutoff) AS (VALUES {_CUTS}),
hit AS (SELECT stratum, signal, pos, cutoff, good, CASE signal {_TEST} END AS r FROM held, cuts),
cnt AS (SELECT stratum, signal, pos, cutoff, count(*) FILTER (good) AS n, count(*) FILTER (good AND r) AS lost, count(*) FILTER (NOT good AND r) AS caught FROM hit GROUP BY ALL),
tail AS (SELECT *, CASE WHEN lost > n * {RISK} THEN 1 ELSE (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln({1 - RISK})))
          FROM unnest(range(0, lost + 1)) AS u(i)) END AS p FROM cnt),
ok AS (SELECT *, bool_and(p <= {ERROR} / (SELECT {len(SIGNALS)} * count(DISTINCT stratum) FROM cnt)) OVER (PARTITION BY stratum, signal ORDER BY pos) AS holds FROM tail),
pick AS (SELECT stratum, signal, first(cutoff ORDER BY caught - {PRICE} * lost DESC, pos) AS cutoff FROM ok WHERE holds AND caught > {PRICE} * lost GROUP BY ALL),
bad AS (SELECT DISTINCT doc_id FROM b JOIN pick ON pick.stratum = b.stratum WHERE CASE signal {_TEST} END)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM b LEFT JOIN bad ON bad.doc_id = b.doc_id
"""
