"""The filter audit against a plain walk through every order."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from filelens.llm import filter_audit as A


def brute(docs, labels):
    """``docs``: doc_id, text, lang; ``labels``: doc_id, quality, toxic."""
    ids = defaultdict(set)
    for i, text, _ in docs:
        if i is not None:
            ids[text or ""].add(i)
    bad = []
    for i, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and min(ids[t]) < i}
        bad.append({f for f, v in fails.items() if v})
    good, toxic = ({d for d, *flags in labels if d is not None and flags[k] == 1} for k in (0, 1))
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for step, letter in enumerate(order, 1):
            for (i, _, lang), fails in zip(docs, bad, strict=True):
                row = out.setdefault((lang or "", "".join(order), step), [0] * 6)
                gone = bool(fails & set(order[: step - 1]))
                removed = letter in fails and not gone
                for k, v in enumerate((not gone and letter not in fails, removed, letter in fails and gone, fails == {letter}, removed and i in good, removed and i in toxic)):
                    row[k] += v
                shapley[lang or "", letter] += removed
    return sorted((*key, *row, shapley[key[0], key[1][key[2] - 1]]) for key, row in out.items())


def run(docs, labels):
    return sorted(tuple(r) for r in A.step_outcomes(docs, labels).collect())


LABELS = "doc_id bigint, quality int, toxic int"


def test_documents_against_brute_force(spark, documents, sf):
    docs = [(d[0], d[1], d[2]) for d in documents] + [(9001, documents[3][1], None), (9002, documents[3][1], "en"), (9003, None, "xx")]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()] + [(9002, 1, 1)]
    got = run(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, LABELS))
    assert got == brute(docs, labels)
    assert len(got) == 600 * len({d[2] or "" for d in docs})


def test_odd_rows_repeated_ids_and_empty_tables(spark, odd, none):
    docs = [(r.doc_id, r.text, r.lang) for r in odd.collect()] + [(8, "SAME #", "en"), (8, "SAME #", "en"), (11, "SAME #", ""), (None, "SAME #", "en")]
    labels = [(8, 1, 0), (8, 0, 1), (11, None, 1), (None, 1, 1), (1, 1, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").selectExpr("*", "1 AS mask", "2 AS part", "3 AS n", "4 AS good", "5 AS l_id")
    have = spark.createDataFrame(labels, LABELS).selectExpr("*", "'x' AS text", "'y' AS lang")
    assert run(df, have) == brute(docs, labels)
    assert run(none, have) == []
    assert run(df, have.limit(0)) == brute(docs, [])


def test_many_parts_and_early_sums(spark, monkeypatch):
    monkeypatch.setattr(A, "PARTS_AT_ONCE", 3)
    docs = [(i, "word " * (i % 150), f"part{i % 17}") for i in range(300)]
    got = run(spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(5), spark.createDataFrame([(3, 1, 1)], LABELS))
    assert got == brute(docs, [(3, 1, 1)])


@pytest.mark.parametrize("n", [1, 10**6, 2**62])
def test_fields_do_not_run_over(n):
    total = n * A.packed(0, True, True) + (n - 1) * A.packed(31, True, True)
    counts = A.unpacked(total)
    assert set(counts["kept"].tolist()) == {n}
    removed = counts["removed"].reshape(120, 5)
    assert (removed[:, 0] == n - 1).all() and (removed[:, 1:] == 0).all()
    assert np.array_equal(counts["removed"], counts["good_lost"])
