"""Repeated passages against a plain walk over the texts."""

from __future__ import annotations

import random
import re

import pytest

from filelens.llm import substring_dedup as S


def cut_up(text):
    """Units by walking over the characters: ``start, end, words, folded``."""
    out, marks = [], False
    bounds = []
    for i, c in enumerate(text):
        if marks and c not in ".!?,;:|\n。！？":
            bounds.append(i)
            marks = False
        marks = marks or c in ".!?,;:|\n。！？"
    at = 0
    for stop in [*bounds, len(text)]:
        words = [(m.start() + at, m.end() + at) for m in re.finditer(r"[^ \t\n\x0b\x0c\r]+", text[at:stop])]
        if words:
            folded = " ".join("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text[a:b]) for a, b in words)
            out.append((words[0][0], words[-1][1], len(words), folded))
        at = stop
    return out


def brute(docs, least):
    """``docs`` by rank, each once: kept text, spans and words removed of each."""
    seen, out = {}, []
    for i, text in docs:
        units, runs = cut_up(text), []
        for at, (a, b, n, folded) in enumerate(units):
            if folded in seen:
                if runs and runs[-1][-1][0] == at - 1:
                    runs[-1].append((at, a, b, n, seen[folded]))
                else:
                    runs.append([(at, a, b, n, seen[folded])])
            else:
                seen[folded] = (len(out), at, i, a)
        spans, kept, last, words = [], "", 0, 0
        for run in runs:
            if sum(u[3] for u in run) < least:
                continue
            words += sum(u[3] for u in run)
            for k, (_, a, b, _, (d, p, f, s)) in enumerate(run):
                if k and run[k - 1][4][:2] == (d, p - 1):
                    spans[-1][1] = b
                else:
                    spans.append([a, b, f, s])
        for a, b, *_ in spans:
            kept += text[last:a] if last == 0 or text[last:a].strip(" \t\n\x0b\x0c\r") else ""
            last = b
        out.append((i, kept + text[last:], [tuple(s) for s in spans], words))
    return out


def run(df, least):
    return [(r.doc_id, r.text, [tuple(s) for s in r.removed_spans], r.removed_words) for r in S.without_repeats(df, least).collect()]


@pytest.mark.parametrize("least", [1, 8, 40])
def test_documents_against_brute_force(spark, documents, least):
    docs = [(d[0], d[1]) for d in documents]
    got = run(spark.createDataFrame(docs, "doc_id bigint, text string"), least)
    assert sorted(got) == brute(docs, least)
    assert least > 1 or any(g[2] for g in got)


def test_random_splices_against_brute_force(spark):
    rng = random.Random(6)
    pool = [" ".join(rng.choices("ab cd ef gh ij kl".split(), k=rng.randint(1, 6))).title() + rng.choice(". |! |, |;\n|.\n\n|?! |. ".split("|")) for _ in range(60)]
    docs = [(i, "".join(rng.choices(pool, k=rng.randint(0, 25)))) for i in range(120)]
    for least in (5, 20):
        assert sorted(run(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), least)) == brute(docs, least)


def test_passage_spliced_into_a_line(spark):
    passage = "Oratin thesntth hathly. Of thtior enwh, thintionor? It are here!"
    texts = [(1, f"One own start. {passage} One own end.\nAnother line of the first."),
             (2, f"Zwei eigen anfang\nund mitten. {passage.upper()}  zwei eigen rest"), (3, "Version 1.5 only.\nNo. 7"), (4, None)]
    rows = {r.doc_id: r for r in S.without_repeats(spark.createDataFrame(texts, "doc_id bigint, text string"), 10).collect()}
    assert [texts[1][1][s.start : s.end] for s in rows[2].removed_spans] == [passage.upper()]
    assert [(s.first_doc_id, s.first_start) for s in rows[2].removed_spans] == [(1, texts[0][1].index(passage))]
    assert rows[2].text == "Zwei eigen anfang\nund mitten.   zwei eigen rest" and rows[2].removed_words == 10
    assert rows[4].text is None and not any(rows[i].removed_spans for i in (1, 3, 4))


def test_each_span_names_its_own_source(spark):
    docs = [(1, "Alpha beta gamma. One more."), (2, "Delta epsilon zeta. Two more."), (3, "Alpha beta gamma. Delta epsilon zeta. Three more.")]
    rows = {r.doc_id: r for r in S.without_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"), 6).collect()}
    assert [tuple(s) for s in rows[3].removed_spans] == [(0, 17, 1, 0), (18, 37, 2, 0)]
    assert rows[3].text == " Three more."


def test_short_repeats_stay(spark):
    docs = [(1, "Yes. No. Maybe so."), (2, "Yes. Certainly not. Yes."), (3, "No. Yes. Yes. No.")]
    out = S.without_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted((r.doc_id, r.text, r.removed_units) for r in out.collect()) == [(i, t, 0) for i, t in docs]


def test_odd_rows_repeated_ids_and_empty_tables(spark, odd, none):
    """Rows of one id and text are one document, other texts of the id are others; null ids come first."""
    line = "the very same passage stands here, word by word, and again it does."
    more = [(7, line), (20, f"{line} {line}"), (20, f"{line} {line}"), (None, line), (21, None)]
    df = odd.selectExpr("doc_id", "text", "1 AS at", "2 AS h1", "lang AS `first`").union(spark.createDataFrame([(i, t, 1, 2, "x") for i, t in more]))
    got = S.without_repeats(df, 10).collect()
    assert len(got) == odd.count() + len(more)
    by = {(r.doc_id, r.removed_units): r for r in got}
    assert by[20, 6].text == "" and [tuple(s) for s in by[20, 6].removed_spans] == [(0, len(line), None, 0), (len(line) + 1, 2 * len(line) + 1, None, 0)]
    assert by[7, 3].text == "" and sum(r.removed_units for r in got if r.doc_id is None) == 0
    assert sum(r.doc_id == 20 and r.text == "" for r in got) == 2
    assert sorted(S.without_repeats(odd).columns) == sorted([*odd.columns, "removed_spans", "removed_units", "removed_words"])
    assert S.without_repeats(none).count() == 0
    with pytest.raises(ValueError):
        S.without_repeats(odd.withColumn("Removed_Units", odd.doc_id))
