"""Personal data: the patterns against Python's re, the disclosing terms against counting."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

from filelens.llm import pii


def brute(text):
    patterns = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
    out = []
    for k, (kind, p) in enumerate(patterns):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(d) <= 19 and pii.luhn(d)):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


def test_patterns_on_random_texts():
    rng = random.Random(3)
    parts = ["a", "b.", "@", "x@y.z", ".", "1", "23", "-", " ", "+", "(", "4111 1111 1111 1111", "1.2.3.4", "é", "%", "\n", "+1 (988) 555-2485", "0256."]
    for _ in range(20000):
        t = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        assert pii.base_spans(t) == brute(t)


def test_long_runs_of_digits_take_linear_time_and_no_crash():
    t0 = time.perf_counter()
    assert pii.base_spans("0" * 200_000) == []
    assert pii.base_spans("7" * 200_000 + ".1.2.3") == []
    assert pii.base_spans("1." * 100_000 + "1") == [(8 * i, 8 * i + 7, "ip") for i in range(25_000)]
    assert pii.base_spans("x " + "0" * 6000 + "12.0.00.255 y") == [(2, 6013, "ip")]
    assert time.perf_counter() - t0 < 2


def brute_disclosing(docs):
    """``(entity, term): disclosure`` by counting lines one by one."""
    words = re.compile(r"[^\W\d_]+")
    n, n_term, n_entity, contexts, both = 0, Counter(), Counter(), defaultdict(set), Counter()
    for _, text in docs:
        spans, at = brute(text or ""), 0
        for line in (text or "").split("\n"):
            n += 1
            n_term.update({m[0] for m in words.finditer(line.lower())})
            own = [s for s in spans if at <= s[0] <= at + len(line)]
            free = [m[0].lower() for m in words.finditer(line) if not any(a < m.end() + at and m.start() + at < b for a, b, _ in own)]
            for e in {f"{k}:{text[a:b].lower()}" for a, b, k in own}:
                n_entity[e] += 1
                for t in set(free):
                    both[e, t] += 1
                    contexts[e, t].add(tuple(free))
            at += len(line) + 1
    told, least = {}, math.log(max(len(both), 1) / pii.CHANCE)
    for (e, t), k in both.items():
        m, support = n_term[t] * n_entity[e] / n, len(contexts[e, t])
        surprise = support * math.log(support / m) - support + m if support > m else 0.0
        if n_entity[e] < n and surprise >= least:
            share = 1 - math.log(n_term[t] / k) / math.log(n / n_entity[e])
            if share >= pii.DISCLOSURE:
                told[e, t] = share
    return told


def test_disclosing_terms_against_counting(spark, documents):
    rng = random.Random(4)
    docs = _corpus() + [(1000 + i, t) for i, t, *_ in documents]
    for i in range(300):  # entities with terms of their own, shared ones, and copies of lines
        who = rng.randrange(8)
        extra = rng.choice(["", f"nick{'abcdefgh'[who]}", "team", f"nick{'abcdefgh'[rng.randrange(8)]}"])
        docs.append((3000 + i, f"{extra} {rng.choice(['met', 'saw', 'called'])} user{who}@site.example.org {rng.choice(['here', 'there', 'then'])}\n{extra}"))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "coalesce(text, '') AS text")
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosing_terms(df, pii.entity_spans(df)).collect()}
    want = brute_disclosing(docs)
    assert got.keys() == want.keys() and len(want) >= 3
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_query_over_documents(spark, sf, documents):
    from filelens.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op9_pii"](spark, sf).collect()}
    assert len(rows) == len(documents)
    for i, text, *_ in documents:
        spans = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in pii.KINDS[:4]] == [sum(s[2] == k for s in spans) for k in pii.KINDS[:4]]
        assert [s for s in rows[i].spans.split(",") if s and not s.startswith("term")] == [s for s in joined.split(",") if s]


def _corpus():
    rng = random.Random(1)
    filler = [f"{a}{b}" for a in "bcdfgh" for b in ("ala", "ene", "ici", "ono", "upu")]
    docs = []
    for i in range(400):
        docs.append((i, " ".join(rng.choices(filler, k=12)) + ".\n" + " ".join(rng.choices(filler, k=12))))
    for i in range(5):  # a nickname that stands only beside one address, in different contexts
        docs.append((500 + i, f"{' '.join(rng.choices(filler, k=4))} zorro writes from zed@mail.example.com {' '.join(rng.choices(filler, k=3))}"))
    docs += [(600, "we all know zorro"), (601, docs[400][1]), (602, "hapax near rare@x.org once"), (603, None)]
    return docs


def test_terms_that_reveal_an_entity(spark):
    docs = _corpus()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = {r.doc_id: r.spans for r in pii.find_spans(df).collect()}
    terms = {i: [text[s.start : s.end] for s in rows[i] if s.kind == "term"] for i, text in docs if text}
    assert all("zorro" in terms[i] for i in (*range(500, 505), 601))
    assert not terms[602], "one context is no evidence"
    assert not any(terms[i] for i in range(400)) and not terms[600]
    assert not any(w[1:] in ("ala", "ene", "ici", "ono", "upu") for t in terms.values() for w in t)


def test_sanitised_texts(spark, odd, none):
    docs = _corpus()
    out = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert "zorro" not in out[500] and "[EMAIL]" in out[500] and "@" not in out[500]
    assert out[0] == docs[0][1] and out[603] is None
    clean = pii.sanitise(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    texts = sorted(r.text or "" for r in clean.collect())
    assert texts == sorted(pii.replaced(r.text or "", brute(r.text or "")) for r in odd.collect())
    assert pii.sanitise(none).count() == 0 and pii.find_spans(none).count() == 0


def test_replacement_of_overlapping_spans():
    assert pii.replaced("a 1.2.3.4 b", [(2, 9, "ip")]) == "a [IP] b"
    assert pii.replaced("x+12 34.5.6.7y", [(1, 8, "phone"), (5, 13, "ip")]) == "x[PHONE]y"


def test_counts_of_terms_cover_all_lines(spark):
    df = spark.createDataFrame([(i, "alpha beta\nalpha\nGamma alpha alpha") for i in range(50)], "doc_id bigint, text string")
    terms = spark.createDataFrame([("alpha",), ("gamma",), ("none",)], "term string")
    assert {r.term: r.n_term for r in pii.term_lines(df, terms).collect()} == {"alpha": 150, "gamma": 50}


def test_two_contexts_are_evidence_for_a_rare_term(spark):
    docs = [d for d in _corpus() if d[0] < 500] + [(700, "ask quixote under dq@mancha.example today"), (701, "quixote rides again, dq@mancha.example")]
    rows = {r.doc_id: r.spans for r in pii.find_spans(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert [[t[s.start : s.end] for s in rows[i] if s.kind == "term"] for i, t in docs[-2:]] == [["quixote"]] * 2
    assert not any(rows[i] for i in range(400))


def test_terms_go_wherever_they_stand_beside_their_entity(spark):
    far = " ".join(["Wb" + "x" * 60] * 12)
    docs = [d for d in _corpus() if d[0] < 505] + [
        (710, "zed@mail.example.com is here\nand Zorro stands on the next line, ZORRO again"), (711, f"zorro {far} zed@mail.example.com"),
        (712, "zorro@other.example or zorro")]
    df = spark.createDataFrame(docs + docs[-3:-2], "doc_id bigint, text string")
    rows = pii.find_spans(df).collect()
    found = {r.doc_id: [dict(docs)[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "term"] for r in rows}
    assert len(rows) == len(docs) + 1
    assert [w for w in found[710] if w.lower() == "zorro"] == ["Zorro", "ZORRO"] and "zorro" in found[711] and not found[712]
    clean = {r.doc_id: r.text.lower() for r in pii.sanitise(df).collect()}
    assert "zorro" not in clean[710] + clean[711] and "zorro" in clean[712]
    assert pii.contexts(docs[-2][1], pii.base_spans(docs[-2][1]))[0][:2] == (["email:zed@mail.example.com"], [("Wb" + "x" * 60).lower(), "zorro"])
