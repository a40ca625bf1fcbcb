"""Byte-level BPE and token counts against the public libraries."""

from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from filelens.llm import bpe, token_counts
from filelens.llm.pretokens import PATTERN, SPACE, WIDE_SPACE, Splitter

ODD = ["", " ", "a  b", "a   b\n\n c \t d", "\n\n", "<|endoftext|> x<|endoftext|>", "a" * 700, "don't we'll I'M", "日本語 と 123٣",
       "a\x1cb \x1f c\x85d\x0be", "🙂👍🏽 ok", " lead", "trail ", "ab" * 2000, "a\nb \nc\n d", " x 　y"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    mixed = ["".join(rng.choice("ab' \n\té1.日🙂") for _ in range(rng.randint(1, 120))) for _ in range(600)]
    each = [f"a{chr(x)}b 1{chr(x)} {chr(x)}{chr(x)}" for x in (*range(1, 0x500), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x3000, 0xFEFF)]
    return ODD + mixed + each


@pytest.fixture(scope="module")
def encoding():
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_public_one():
    assert PATTERN == P.PATTERN


def test_units_keep_the_pre_tokens(texts):
    split = Splitter()
    for t in texts:
        assert [x for u in split.units(t) for x in split.tokens(u)] == split.tokens(t)


def test_white_space_is_the_patterns():
    assert set(SPACE + WIDE_SPACE) == {chr(c) for c in range(0x110000) if regex.match(r"\s", chr(c))}


def test_a_column_is_cut_into_units_with_the_same_pre_tokens(texts):
    rng = random.Random(6)
    spaces = SPACE + WIDE_SPACE + "\x1c\x1f"
    runs = ["".join(rng.choice(spaces + "ab'1.é日🙂ʀ\u2030\u0105") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts = texts + runs
    for pattern in (PATTERN, r"\w+\s*|\W"):
        split, find = Splitter(pattern), regex.compile(pattern).findall
        for column, want in ((pa.array(texts, pa.large_string()), texts), (pa.array(texts, pa.large_string()).slice(7, 500), texts[7:507])):
            units, first = split.cut(column)
            coded = units.dictionary_encode()
            tokens, starts, place = split.tokens_of(coded.dictionary)
            places = [place[i] for i in coded.indices.to_pylist()]
            got = [[x for p in places[a:b] for x in tokens[starts[p] : starts[p + 1]]] for a, b in zip(first[:-1], first[1:], strict=True)]
            assert got == [find(t) for t in want]


def test_the_pattern_runs_over_a_batch_and_not_unit_by_unit(encoding, monkeypatch):
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        codec = bpe.Codec(f.read())
    calls, find = [], codec._split._find
    monkeypatch.setattr(codec._split, "_find", lambda text: calls.append(text) or find(text))
    texts = [" ".join(f"word{chr(97 + i)}{j:x}" for j in range(300)) for i in range(5)]
    assert [x.tolist() for x in codec.encode(texts)] == [encoding.encode_ordinary(t) for t in texts]
    assert len(calls) <= 1 + 2 * len(texts)


def test_columns_of_nothing_and_unknown_ids():
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        codec = bpe.Codec(f.read())
    assert codec.encode([]) == [] and codec.decode([]) == []
    assert [x.tolist() for x in codec.encode(["", ""])] == [[], []]
    assert codec.decode(codec.encode(["", "a", ""])) == [b"", b"a", b""]
    for wrong in (-1, 10**8):
        with pytest.raises((KeyError, IndexError)):
            codec.decode([[wrong]])


def test_codec_equals_the_library_and_round_trips(texts, documents, encoding):
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        codec = bpe.Codec(f.read())
    texts = texts + [d[1] for d in documents]
    ids = codec.encode(texts)
    for t, mine in zip(texts, ids, strict=True):
        assert mine.tolist() == encoding.encode_ordinary(t)
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_tree_of_one_equals_the_forest():
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        vocab = bpe.Vocabulary(f.read())
    words = [b"inthebeginning", b"aaaaaaaaaaaaaaa", b"ab", b"zq", "éèàüß".encode()]
    flat, ends = bpe.merge_forest(words, 16, vocab)
    got = [flat[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    assert got == [bpe.merge_one(w, vocab) for w in words]


def test_caches_may_be_dropped_at_any_time(documents, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 10)
    monkeypatch.setattr(token_counts, "CACHE_UNITS", 10)
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        small, whole = bpe.Codec(f.read()), None
    texts = [d[1] for d in documents[:40]]
    parts = [small.encode([t])[0].tolist() for t in texts]
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        whole = bpe.Codec(f.read())
    assert parts == [x.tolist() for x in whole.encode(texts)]


def test_counts_equal_the_library(texts, documents):
    path = P.path(token_counts.VOCABULARY)
    with open(path, "rb") as f:
        counter = token_counts.Counter(f.read())
    library = Tokenizer.from_file(path)
    texts = texts + [d[1] for d in documents]
    assert counter.count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_vocabulary_with_other_rules_is_refused():
    with pytest.raises(ValueError):
        token_counts.Counter(b'{"model": {"type": "WordPiece"}, "added_tokens": []}')


def test_queries_over_odd_rows(odd, none, encoding):
    path = P.path(bpe.VOCABULARY)
    rows = bpe.with_digests(bpe.encode_decode(odd, path)).collect()
    assert len(rows) == odd.count()
    want = sorted((r.doc_id or -1, hashlib.sha256(",".join(map(str, encoding.encode_ordinary(r.text or ""))).encode()).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd.collect())
    assert sorted((r.doc_id or -1, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert bpe.encode_decode(none, path).count() == 0
    coded = bpe.encode_decode(odd, path, decoded=False)
    assert sorted(bytes(r.decoded) for r in bpe.decode(coded, path).collect()) == sorted((r.text or "").encode() for r in odd.collect())

    counted = token_counts.count_tokens(odd, P.path(token_counts.VOCABULARY))
    library = Tokenizer.from_file(P.path(token_counts.VOCABULARY))
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in counted.collect()) == want
    assert token_counts.count_tokens(none, P.path(token_counts.VOCABULARY)).count() == 0
