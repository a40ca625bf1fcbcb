"""Winnowing against every window of every item, by brute force."""

from __future__ import annotations

import random
import re

from filelens.llm import decontamination as D


def words(text):
    return re.findall(D.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            m = min(D.WINDOW, len(iw))
            wins = {tuple(iw[i : i + m]) for i in range(len(iw) - m + 1)} if m else set()
            for i in range(len(ws) - m + 1 if m else 0):
                if tuple(ws[i : i + m]) in wins:
                    hit.update(range(i, i + m))
                    if item_id is not None:
                        found.add(str(item_id))
        out.append((doc_id if doc_id is not None else -1, len(ws), len(hit), ",".join(sorted(found))))
    return sorted(out)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    rows = D.contaminated_words(d, b).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, ",".join(r["items"])) for r in rows)


def test_random_texts(spark):
    rng = random.Random(2)
    few = [f"w{i}" for i in range(4)] + ["É", "ß", "The"]
    many = [f"t{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(many if i % 2 else few, k=rng.choice([0, 1, 2, 3, 5, 12, 13, 14, 30])))) for i in range(24)]
    items += [(None, "an item without id has thirteen words or more so that it is a window of its own"), (3, items[3][1]), (50, None), (10, items[5][1])]
    docs = []
    for i in range(120):
        parts = [" ".join(rng.choices(many if i % 3 else few, k=rng.randint(0, 40))) for _ in range(3)]
        parts.insert(1, (rng.choice(items)[1] or "").upper())
        docs.append((i, " -- ".join(parts)))
    docs += [(None, items[-4][1]), (200, None), (201, ""), (202, "..!"), (0, docs[0][1]), (0, items[7][1]), (203, " ".join([items[9][1]] * 400))]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_sides(spark):
    docs, items = [(1, "a b c"), (2, None)], [(1, "x")]
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, docs, [(1, None)]) == brute(docs, [])
    assert run(spark, [], items) == []


def test_rows_with_odd_values(spark, odd, none):
    items = spark.createDataFrame([(1, "the lazy dog the quick brown fox jumps over the lazy dog the quick brown"), (2, "same id")], "item_id bigint, text string")
    rows = D.contaminated_words(odd, items).collect()
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, ",".join(r["items"])) for r in rows) == brute(
        docs, [(r.item_id, r.text) for r in items.collect()])
    kept = D.without_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(
        t or "" for (i, t), b in zip(docs, [brute([d], [(1, items.first().text), (2, "same id")])[0] for d in docs], strict=True)
        if not (b[2] > 0 and 20 * b[2] >= b[1]))
    assert D.without_contaminated(none, items).count() == 0


def test_main_path_is_native(spark, sf):
    from filelens.llm.queries import QUERIES

    plan = QUERIES["op2_decontamination"](spark, sf)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_long_text_that_is_an_item_takes_time_in_proportion(spark):
    """Its kept hashes are found by bisection, not one by one."""
    import random
    import time

    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    took = {}
    for n in (2_000, 20_000, 60_000):  # the first one warms up
        text = " ".join(words[:n])
        docs = spark.createDataFrame([(1, f"before it {text} after it"), (2, "no word of it at all")], "doc_id bigint, text string")
        t0 = time.perf_counter()
        rows = {r.doc_id: r for r in D.contaminated_words(docs, spark.createDataFrame([("x", text)], "item_id string, text string")).collect()}
        took[n] = time.perf_counter() - t0
        assert (rows[1].n_hit, rows[1].n_words, rows[2].n_hit) == (n, n + 4, 0)
    assert took[60_000] < 4 * took[20_000]


def test_bisection_finds_what_is_held(spark):
    import random

    rng = random.Random(2)
    rows = [(sorted(rng.sample(range(-500, 500), k)), [rng.randrange(-510, 510) for _ in range(40)]) for k in (0, 1, 2, 3, 64, 65, 300)]
    df = spark.createDataFrame(rows, "s array<bigint>, v array<bigint>")
    got = df.select("s", "v", D._found_in("v", "s").alias("hit")).collect()
    assert all(r.hit == [x in set(r.s) for x in r.v] for r in got)
