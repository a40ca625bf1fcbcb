"""Toxicity network and language machines: gradients, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from filelens.llm import gru, toxicity
from filelens.llm import language_id as L

BAD = ["moron", "clown", "scum"]


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(3)
    words = ["".join(rng.choices("abdeghiklmnorstu", k=rng.randint(2, 8))) for _ in range(150)]
    rows = []
    for i in range(260):
        ws = rng.choices(words, k=rng.choice([3, 20, 60, 150]))
        if i % 3 == 0:
            ws[rng.randrange(len(ws))] = rng.choice(BAD) + rng.choice(["", "!!", "."])
        rows.append((i, " ".join(ws).capitalize(), int(i % 3 == 0)))
    return rows


@pytest.fixture(scope="module")
def network(labelled):
    steps, gru.STEPS = gru.STEPS, 150
    learn = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 5]
    net = gru.train([r[1] for r in learn], [r[2] for r in learn])
    gru.STEPS = steps
    return net


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = gru.train(["one two three", "four five moron"], [0, 1]) if gru.STEPS < 5 else None
    steps, gru.STEPS = gru.STEPS, 2
    net = gru.train(["one two three one", "four five moron"] * 3, [0, 1] * 3)
    gru.STEPS = steps
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = ["one", "two", "moron", "unseen", "é"]
    X = net.inputs(words, *gru.trigrams(words)).astype(np.float64)
    idx, inside, y = rng.integers(0, 5, (3, 6)), np.arange(6) < np.array([[6], [4], [1]]), np.array([1.0, 0, 1])
    g, d_X = net.gradients(X, idx, inside, y)

    def loss():
        z = net.logits(X, idx, inside)
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))

    for array, grad in [*((net.p[k], g[k]) for k in g), (X, d_X)]:
        flat, at = array.reshape(-1), rng.integers(array.size)
        old = flat[at]
        flat[at] = old + 1e-4
        up = loss()
        flat[at] = old - 1e-4
        down = loss()
        flat[at] = old
        assert (up - down) / 2e-4 == pytest.approx(np.asarray(grad).reshape(-1)[at], abs=1e-4)


def test_windows_cover_every_word():
    for n in range(1, 400):
        starts = gru.windows_of(n)
        assert starts[0] == 0 and starts[-1] + gru.WINDOW >= n and (np.diff(starts) == gru.STRIDE).all()


def test_held_out_texts(labelled, network):
    scorer = gru.Scorer(network.dump())
    rest = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    said = scorer.scores([r[1] for r in rest]) >= 0.5
    assert (said == np.array([r[2] for r in rest], bool)).mean() > 0.9


def test_late_word_in_a_long_text_counts_and_scores_do_not_depend_on_batches(labelled, network):
    scorer = gru.Scorer(network.dump())
    clean = " ".join(r[1] for r in labelled if not r[2])
    texts = [clean, clean + " moron scum", "", None, "123 ...", "moron"]
    together = scorer.scores(texts)
    alone = np.array([gru.Scorer(network.dump()).scores([t])[0] for t in texts])
    assert together == pytest.approx(alone, abs=1e-5)
    assert together[1] > 0.5 and together[5] > 0.5 and together[2] == together[3] == together[4] < 0.5


def test_toxicity_over_tables(spark, labelled, odd, none, monkeypatch):
    monkeypatch.setattr(gru, "STEPS", 150)
    docs = spark.createDataFrame([r[:2] for r in labelled], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], 0, r[2]) for r in labelled] + [(0, 1, 1), (None, 1, 1), (1, 0, None)], "doc_id bigint, quality int, toxic int")
    sample = toxicity.training_sample(docs, labels).collect()
    learn = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 5]
    assert sorted(r.text for r in sample) == sorted({r[1] for r in learn})
    assert len(toxicity.training_sample(docs, labels, most=7).collect()) == 7
    net = toxicity.fit(docs, labels)
    scored = toxicity.score_toxicity(odd.drop("score"), net)
    assert scored.count() == odd.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score_toxicity(none.drop("score"), net).count() == 0
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert {r.score for r in toxicity.score_toxicity(docs, None).collect()} == {0.0}
    kept = toxicity.without_toxic(odd.unionByName(docs.selectExpr("doc_id", "text", "'en' lang", "'s' source", "1L n_chars", "'c' score")), labels)
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    assert sum(any(b in (t or "").lower() for b in BAD) for t in texts) < 0.15 * sum(r[2] for r in labelled)
    assert len(texts) > 0.9 * (sum(1 - r[2] for r in labelled) + odd.count())


def test_languages_of_held_out_documents(spark, sf):
    from filelens.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    rows = QUERIES["op10_language_id"](spark, sf).join(docs, "doc_id").collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(len(rows))}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.truth for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_over_odd_rows(spark, odd, none, documents):
    texts = [d for d in documents if d[2]][:120]
    learn = spark.createDataFrame([(d[0], d[1], d[2]) for d in texts] + [(1000, None, "xx"), (1001, "123", "xx"), (1002, "abc def", None)],
                                  "doc_id bigint, text string, lang string")
    machines = L.fit(learn)
    assert set(machines.langs) == {d[2] for d in texts if zlib.crc32(str(d[0]).encode()) % 4 != 2}
    rows = L.identify(odd.drop("score", "lang"), machines).collect()
    assert len(rows) == odd.count()
    for r in rows:
        no_letter = not any(map(str.isalpha, r.text or ""))
        assert (r.lang_pred == "und" and r.score == 0) == no_letter
    assert L.identify(none.drop("score"), machines).count() == 0
    assert L.fit(learn.limit(0)) is None
    assert {(r.lang_pred, r.score) for r in L.identify(odd.drop("score"), None).collect()} == {("und", 0.0)}
    assert L.training_sample(learn, most=8).count() <= 8


def test_the_sample_reads_whole_texts_and_deals_out_a_hot_language(spark, monkeypatch):
    """A late part of a long text counts, and the least hashes of a language are the same in any number of shares."""
    rows = [(i, "die der das und " * 400 + "the of and to " * 800, "en") for i in range(4)] + [(i, f"nicht die {i} der", "de") for i in range(4, 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    picked = []
    for shares in (1, 7, 64):
        monkeypatch.setattr(L, "SHARES", shares)
        picked.append(sorted((r.p_lang, r.p_key) for r in L.training_sample(df, most=10).collect()))
    assert picked[0] == picked[1] == picked[2] and sum(x == "de" for x, _ in picked[0]) == 5
    assert L.fit(df).predict(["the and of to", "der und die"])[0] == ["en", "de"]


def test_names_that_a_result_adds_are_refused(spark, odd):
    with pytest.raises(ValueError, match="score"):
        toxicity.score_toxicity(odd, None)
    with pytest.raises(ValueError, match="score"):
        L.identify(odd, None)
    with pytest.raises(ValueError, match="lang_pred"):
        L.identify(odd.drop("score").withColumn("LANG_PRED", F.lit(1)), None)


def test_one_language_and_one_family():
    one = L.Machines.fit(["abc def"], ["qq"])
    assert one.predict(["hello", ""])[0] == ["qq", "und"]
    two = L.Machines.fit(["der die und das " * 5, "the and of to " * 5], ["de", "en"])
    assert L.Machines.load(two.dump()).predict(["the of and", "die und der"])[0] == ["en", "de"]
