"""Near-duplicate components against all pairs, by brute force."""

from __future__ import annotations

import random
import re
import weakref

import numpy as np
import pytest

from filelens.llm import common as C
from filelens.llm import minhash as M


def shingles(text, k):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(ws) < k:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)}


def brute(docs, k):
    sets = [shingles(t, k) for _, t in docs]
    group = list(range(len(docs)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                group[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted((-1 if d is None else d, len(s), -1 if (c := least.get(top(i))) is None else c)
                  for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True)))


def run(df, k):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                  for r in M.near_duplicates(df, shingle_size=k).collect())


@pytest.mark.parametrize("k", [2, 5])
def test_random_groups(spark, k):
    rng = random.Random(k)
    docs = []
    for g in range(25):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 3, 8, 40, 120]))]
        for _ in range(rng.choice([1, 2, 6])):
            text = [w if rng.random() > 0.03 else f"z{rng.randint(0, 99)}" for w in base]
            docs.append((len(docs) * 7 % 1000, " ".join(text).title()))
    docs += [(2000, None), (2001, ""), (2002, " \n"), (docs[0][0], docs[0][1]), (None, docs[1][1]), (None, "alone without id")]
    rng.shuffle(docs)
    assert run(spark.createDataFrame(docs, "doc_id bigint, text string"), k) == brute(docs, k)


@pytest.mark.parametrize("step", [3, 11, 17])
def test_a_chain_of_edits_stays_as_it_is(spark, step):
    """Neighbours are alike, the ends are not: hubs alone would not do."""
    words = [f"a{i}" for i in range(200)]
    docs = []
    for i in range(60):
        for j in range(step):
            words[(step * i + 7 * j) % 200] = f"b{i}-{j}"
        docs.append((i, " ".join(words)))
    assert run(spark.createDataFrame(docs, "doc_id bigint, text string"), 2) == brute(docs, 2)


def test_edited_copies_of_one_text_beside_their_hub(spark):
    """Many copies around the threshold of being alike the original and each other."""
    rng = random.Random(9)
    base = [f"a{i}" for i in range(150)]
    docs = [(0, " ".join(base))]
    for i in range(1, 220):
        words = [w if rng.random() > (i % 12) / 60 else rng.choice(["", f"z{rng.randint(0, 40)}"]) for w in base]
        docs.append((i, " ".join(words)))
    for i in range(220, 260):  # edits of edited copies
        words = docs[i - 150][1].split()
        words[rng.randrange(len(words))] = f"y{i}"
        docs.append((i, " ".join(words)))
    assert run(spark.createDataFrame(docs, "doc_id bigint, text string"), 2) == brute(docs, 2)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1500).astype(np.uint64)
    a, b, tiny = np.sort(pool[:1000]), np.sort(pool[200:1200]), np.sort(pool[:1])
    s = M.sketches([a, b, tiny, a], 160)
    assert (s != np.uint64(2**64 - 1)).all()
    assert (s[0] == s[3]).all()
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.15


def test_odd_rows_and_empty_tables(spark, odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert run(odd, 2) == brute(docs, 2)
    assert run(none, 2) == []
    kept = M.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    # the repeated row once, both texts of id 7, every row without words or linked with nothing (two are empty without id or with one)
    assert kept.count() == odd.count() - 1
    assert M.without_near_duplicates(none).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(f"{i:03d}".encode(), f"{i + 1:03d}".encode()) for i in range(70)], "a binary, b binary")
    roots = {bytes(r.node): bytes(r.root) for r in M.components(links).collect()}
    assert set(roots.values()) == {b"000"} and len(roots) == 70


def test_differences_of_hubs_and_nodes(spark, monkeypatch):
    """By brute force; what goes to Python are the elements that differ, once, not the sets."""
    rng = random.Random(4)
    draw = lambda n: [rng.getrandbits(64) - 2**63 for _ in range(n)]
    hub, pairs = draw(300), []
    for i, off in enumerate([0, 1, 5, 20, 33, 34, 60, 300]):
        node = [*hub[: 300 - off], *draw(rng.randint(off // 2, off) + (i == 0))]
        pairs.append((b"hub", f"{i}".encode(), *(sorted(x, key=lambda v: v % 2**64) for x in (hub, node))))
    df = spark.createDataFrame(pairs, "hub binary, node binary, hub_set array<bigint>, node_set array<bigint>")
    found = {bytes(r.node): r for r in M.hub_differences(df, 80).collect()}
    handed, map_arrow = [], C.map_arrow
    monkeypatch.setattr(C, "map_arrow", lambda rows, *a, **k: (handed.append(rows), map_arrow(rows, *a, **k))[1])
    M.hub_differences(df, 80)
    given = {bytes(r.node): r for r in handed[0].collect()}
    assert len(found) == len(given) == len(pairs)
    for _, name, h, x in pairs:
        r, own, gone = found[name], set(x) - set(h), set(h) - set(x)
        assert (r.n, r.s, r.linked) == (len(x), len(own) + len(gone), 5 * len(set(h) & set(x)) >= 4 * len(set(h) | set(x)))
        least = (r.s + (len(h) - len(x)) / 9) / 2 if r.linked else (r.s - len(x) / 4) / 2
        kept = min(r.s, r.s - max(1, int(np.ceil(least - 1e-6))) + 1)
        assert len(r.prefix) == kept and set(r.prefix[: len(own)]) <= own and set(r.prefix[len(own) :]) <= gone
        assert sum(len(v) for v in given[name] if isinstance(v, list)) == r.s


def test_a_worker_keeps_the_state_of_one_operator(spark):
    """The words of one operator, the vocabularies of others: each goes when the next one's state is built."""

    class State:
        def __init__(self, data):
            self.data = data

    files = [C.SharedFile(spark, data) for data in (b"one", b"two", b"three")]
    seen = []
    for f in files:
        assert f.made(State) is f.made(State)
        seen.append(weakref.ref(f.made(State)))
    assert [x() is not None for x in seen] == [False, False, True]
    words = M._words()
    words[b"word"] = 1
    assert seen[-1]() is None and M._words() is words
    assert files[0].made(State).data == b"one" and M._words() == {}


def test_parities_bound_differences():
    """No more than sets of any two sizes differ by, and near it for sets that are far from alike."""
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 2**63, 9000).astype(np.uint64))
    for n in (1, 2, 15, 16, 17, 400, 3000):
        assert len(M.parities(pool[:n])) * 8 >= 4 * n and M.least_difference(M.parities(pool[:n]), M.parities(pool[:n])) == 0
        for shift, longer in ((0, n // 4), (n // 10, 0), (n // 3, n // 5), (n, 3 * n)):
            a, b = pool[:n], pool[shift : n + shift + longer]
            differ = len(np.setxor1d(a, b))
            for x, y in ((a, b), (b, a)):
                assert M.least_difference(M.parities(x), M.parities(y)) <= differ
            if n >= 400 and shift == n // 3:
                assert M.least_difference(M.parities(a), M.parities(b)) * 180 > (len(a) + len(b)) * 20


def test_pairs_beside_hubs_miss_none_and_pass_few(spark):
    """Edits of a far relative of the hub: by brute force, after the parities of full sets too."""
    rng = random.Random(8)
    hub = sorted(rng.getrandbits(63) for _ in range(200))
    far = hub[:140] + [rng.getrandbits(63) for _ in range(60)]
    sets = {b"hub": hub}
    for i in range(30):
        near = [x if rng.random() > (i % 10) / 40 else rng.getrandbits(63) for x in (far if i % 3 else hub)]
        sets[f"{i:02d}".encode()] = sorted(set(near[: rng.randint(170, 200)]))
    alike = lambda a, b: 5 * len(set(a) & set(b)) >= 4 * len(set(a) | set(b))
    star = spark.createDataFrame([(b"hub", k, hub, v) for k, v in sets.items() if k != b"hub"],
                                 "hub binary, node binary, hub_set array<bigint>, node_set array<bigint>")
    differences = C.stored(M.hub_differences(star, 80), "differences")
    root = spark.createDataFrame([], "node binary, root binary")
    linked = {bytes(r.node): r.linked for r in differences.collect()}
    pairs = C.stored(M.pairs_beside_hubs(differences, root, 80), "met")
    rows = [(k, len(v), M.parities(np.array(v, np.uint64))) for k, v in sets.items()]
    few = M.perhaps_alike(pairs, spark.createDataFrame(rows, "node binary, n bigint, parity binary"), 80)
    found, met = ({(bytes(r.a), bytes(r.b)) for r in df.collect()} for df in (few, pairs))
    names = sorted(linked)
    wanted = {(b, a) for b in names for a in names if a < b and not (linked[a] and linked[b]) and alike(sets[a], sets[b])}
    assert wanted and wanted <= found <= met


def test_sets_and_keys_are_not_shuffled_for_nothing(spark, monkeypatch):
    """Keys are dealt out alone, once; sets go to no shuffle before those of hubs and of pairs that may be alike."""
    rng = random.Random(6)
    docs = [(i, " ".join(f"w{rng.randint(0, 5000)}" for _ in range(60))) for i in range(300)]
    docs += [(300 + i, docs[i][1] + " end") for i in range(20)]
    plans, stored = {}, C.stored
    monkeypatch.setattr(C, "stored", lambda df, name: (plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()), stored(df, name))[1])
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sum(r.kept for r in M.near_duplicates(df, shingle_size=2).collect()) == 300
    lines = {name: [x for x in plan.splitlines() if "Exchange hashpartitioning" in x] for name, plan in plans.items()}
    assert any("hashpartitioning(key#" in x for x in lines["keys"])
    assert "keyed" in plans and not lines["keyed"] or all("key#" not in x for x in lines["keyed"])
    # the bitmap's slots are grouped; rows of texts and sets are not
    assert all("_groupingexpression" in x for x in lines["sets"]) and "keys#" not in plans["wanted"].split("Scan")[0]
    assert {"keys", "keyed", "pairs", "hubs"} <= set(plans)


def test_classes_of_many_copies_beside_single_rows(spark):
    """Copies, repeated rows and a null id: one row a class leads, whichever rows the bitmap lets through."""
    rng = random.Random(12)
    docs = []
    for g in range(12):
        words = [f"g{g}-{rng.randint(0, 90)}" for _ in range(40)]
        docs += [(1000 - len(docs), " ".join(words)) for _ in range(1 + 4 * (g % 3))]
        docs += [(2000 + len(docs), " ".join([*words[:38], "x", f"y{g}"]))] * (1 + g % 2)
    docs += [(None, docs[0][1]), (None, docs[0][1]), (None, "one two three"), (None, "one two three")]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert run(df, 2) == brute(docs, 2)
    rows = spark.createDataFrame([(f"{i % 7}".encode(), [i % 7]) for i in range(20)] + [(b"alone", [9])], "node binary, shingles array<bigint>")
    assert sorted((bytes(r.node), r.shingles) for r in M.one_a_node(rows).collect()) == [*((f"{i}".encode(), [i]) for i in range(7)), (b"alone", [9])]
