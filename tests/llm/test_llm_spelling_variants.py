"""Spelling variants against edits made one by one."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from filelens.llm import spelling_variants as V


def brute_counts(docs):
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def brute_variants(counts, ratio=10, roots=True):
    gaps = {}
    for w in counts:
        for i in range(len(w)):
            gaps.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    near = {w: set() for w in counts}
    for (a, b), words in gaps.items():
        for w in words:
            near[w] |= words - {w}
            if (a + b) in counts:
                near[w].add(a + b)
                near[a + b].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while roots and form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(rows, key=lambda r: r[0])


def run(df, **kw):
    return sorted((tuple(r) for r in V.variant_groups(df, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


def test_documents_against_brute_force(spark, documents):
    docs = [d[:2] for d in documents]
    got = run(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert got == brute_variants(brute_counts(docs))
    assert any(r[1] for r in got)


@pytest.mark.parametrize("subtree", [1, 3, 40, 5000])
def test_any_cut_of_the_trie_finds_all_neighbours(spark, monkeypatch, subtree):
    """Also where words of one vector fill several subtrees."""
    monkeypatch.setattr(V, "SUBTREE", subtree)
    rng = random.Random(subtree)
    words = {"".join(rng.choice("abié") for _ in range(rng.randint(7, 9))) for _ in range(250)}
    words |= {"abcdefg", "gfedcba", "bacdefg", "abcdefgh", "xabcdefg", "abcdefÿ"}
    counts = {w: rng.choice([2, 3, 25, 300, 4000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = {r.word: (r.n_near, r.best, r.best_n) for r in V.near_words(df).collect()}
    want = {r[0]: r[4] for r in brute_variants(counts, ratio=0, roots=False)}
    best = {r[0]: (r[1], r[5]) for r in brute_variants(counts, ratio=0, roots=False)}
    assert {w: n for w, (n, *_) in got.items()} == want
    assert {w: hit[1:] for w, hit in got.items()} == best


def test_pairs_of_words_as_rows_of_a_matrix():
    rng = random.Random(8)
    words = ["".join(rng.choices("abà", k=rng.randint(1, 6))) for _ in range(300)] + ["x" * n for n in (46, 47, 48, 49, 50, 300, 301)] + ["y" + "x" * 47, "x" * 299 + "y"]
    held = V.Words(words)
    i, j = (a.ravel() for a in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    assert V.verified(held, i, held, j).tolist() == [V.one_edit(words[a], words[b]) for a, b in zip(i, j, strict=True)]
    assert held.paths.sum(1).tolist() == list(map(len, words))


def test_ways_of_a_search_are_distinct_also_for_great_counts():
    top = (1 << V.KEY_BITS) - 1
    digits = np.array([[0, 0, 0], [2, 1, 0], [top, 1, top + 5], [top - 1, top + 1, 3], [5000, 5000, 5000]])
    row, key = V.reachable(digits)
    assert len(set(zip(row.tolist(), key.tolist()))) == len(row)
    for k, own in enumerate(digits):
        want = set()
        for delta in product((-1, 0, 1), repeat=3):
            moves = [x for x in delta if x]
            if moves in ([], [1], [1, -1]) and (own + delta >= 0).all():
                want.add(int(V.subtree_keys((own + delta)[None])[0]))
        assert want == set(key[row == k].tolist())


def test_one_edit():
    yes = [("abcdefg", "abcdefgh"), ("abcdefg", "bcdefg"), ("abcdefg", "abXdefg"), ("aaaaaaa", "aaaaaaaa"), ("ab", "b")]
    no = [("abcdefg", "abcdefg"), ("abcdefg", "bacdefg"), ("abcdefg", "abcdefghi"), ("abcdefg", "abcdeh"), ("aéb", "abc")]
    assert all(V.one_edit(a, b) and V.one_edit(b, a) for a, b in yes)
    assert not any(V.one_edit(a, b) or V.one_edit(b, a) for a, b in no)


def test_roots_follow_a_chain_and_ties_take_the_smallest(spark):
    text = " ".join(["aaaaaaa"] * 2 + ["aaaaaab"] * 40 + ["aaaaabb"] * 900 + ["zaaaaaa"] * 40)
    got = {r[0]: r[1:] for r in run(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), every=1 << 40)}
    assert got["aaaaaaa"] == ("aaaaaab", "aaaaabb", 2, 2, 40)
    assert got["aaaaaab"] == ("aaaaabb", "aaaaabb", 40, 2, 900)
    assert got["aaaaabb"] == (None, "aaaaabb", 900, 1, None)


def test_odd_rows_and_empty_tables(spark, odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()] + [
        (9, "ÀÉÎöüßñ×÷ Straßenbahn STRASSENBAHN strassenbahN straßenbahn " + "x" * 29999)] * 2
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'x' AS word", "1 AS n", "2 AS head", "3 AS form")
    assert run(df) == brute_variants(brute_counts(docs))
    assert run(none) == []
    assert run(spark.createDataFrame([(1, None), (None, None), (2, "")], "doc_id bigint, text string")) == []
