"""Quality signals against plain loops, bounds against exact fractions."""

from __future__ import annotations

import math
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from filelens.llm import quality_rules as Q


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    held = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(lines), len(held)


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def test_signals_against_brute_force(spark, documents, odd):
    texts = [d[1] for d in documents] + [r.text for r in odd.collect()] + [
        "a b a b a b a", "a a a a", "a b c x a b c", "a b c d a b c d", "x\n x\nx\n\n\n \nx\r", "# <b> & | 100%\n#", "one two", "\x1c odd\x85space\xa0here\x0b\x0cx"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in Q.text_signals(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("n,k", [(0, 0), (1, 0), (50, 0), (50, 1), (200, 3), (1000, 7), (1000, 20), (1000, 21), (40000, 700), (2_000_000, 39_000)])
def test_binomial_tail_is_exact(spark, n, k):
    got = spark.range(1).select(Q.binomial_tail(F.lit(n).cast("bigint"), F.lit(k).cast("bigint"), 0.02)).first()[0]
    if k > n * 0.02:
        assert got == 1.0
    elif n <= 1000:
        r = Fraction(1, 50)
        assert got == pytest.approx(float(sum(math.comb(n, i) * r**i * (1 - r) ** (n - i) for i in range(k + 1))), rel=1e-9)
    else:
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.02) + (n - i) * math.log(0.98) for i in range(k + 1)]
        top = max(terms)
        assert got == pytest.approx(math.exp(top) * math.fsum(math.exp(x - top) for x in terms), rel=1e-6)


def _labelled(spark, n_good, n_poor, lang="en", symbols=0):
    """Good documents without symbols (but for ``symbols`` of them), poor ones full of them."""
    plain = " ".join(f"word{i}" for i in range(60))
    rows = [(i, plain + (" #" * 40 if i < symbols else ""), lang) for i in range(n_good)]
    rows += [(10**6 + i, plain + " #" * 40, lang) for i in range(n_poor)]
    return rows, [(r[0], int(r[0] < 10**6), 0) for r in rows]


def _judged(spark, rows, labels):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return Q.judged(df, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_cutoffs_need_enough_labels(spark):
    """(1 - RISK)^n has to fall below the error allowed: 228 good documents do for five pairs, 227 do not."""
    least = math.ceil(math.log(Q.ERROR / len(Q.SIGNALS)) / math.log(1 - Q.RISK))
    for n, keeps in ((least, False), (least - 1, True)):
        rows, labels = _labelled(spark, n, 30)
        assert {r.kept for r in _judged(spark, rows, labels).where("doc_id >= 1000000").collect()} == {keeps}


def test_each_stratum_by_its_own_labels_and_errors_shared(spark):
    rows, labels = _labelled(spark, 600, 30)
    more, known = _labelled(spark, 60, 30, lang="de")
    more = [(i + 5 * 10**6, t, x) for i, t, x in more]
    known = [(i + 5 * 10**6, int(i < 10**6), 0) for i, *_ in known]
    kept = {r.doc_id: r.kept for r in _judged(spark, rows + more, labels + known).collect()}
    assert not any(kept[i] for i, *_ in rows if i >= 10**6) and all(kept[i] for i, *_ in rows if i < 10**6)
    assert all(kept[i] for i, *_ in more)  # too few labels in this stratum


def test_false_rejections_end_the_tests_of_a_signal(spark):
    rows, labels = _labelled(spark, 600, 30, symbols=30)  # five in a hundred good ones lost
    assert all(r.kept for r in _judged(spark, rows, labels).collect())


def test_odd_rows_and_empty_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 1)], "doc_id bigint, quality int, toxic int")
    df = odd.selectExpr("*", "1 AS words", "2 AS stratum", "3 AS l_id", "4 AS hashes", "5 AS good")
    got = Q.judged(df, labels).collect()
    assert len(got) == odd.count()
    assert sorted((tuple(r[c] for c in COLS), r.base_failed, r.kept) for r in got) == sorted(
        (b := brute(r.text), f := b[0] < 50 or 100 * b[5] > 50 * b[0], not f) for r in odd.collect())
    assert Q.judged(none, labels).count() == 0
    assert Q.judged(odd, labels.limit(0)).count() == odd.count()


def test_native_plan(spark, sf):
    plan = Q.op13_quality_rules(spark, sf)._jdf.queryExecution().toString()
    signals = Q.text_signals(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan + signals for x in ("Python", "MapInArrow", "MapInPandas", "Arrow"))
