"""Byte-level BPE encoding and decoding with segment trees.

The pairs of a pre-token are the leaves of a segment tree over its byte
positions; every node holds the least ``(rank, position)`` below it, so the
root names the leftmost pair of minimum rank.  A merge changes three leaves -
the pair itself, the one that vanishes and the one before - each a logarithmic
point update; links to the previous and next live position skip merged bytes.

Short pre-tokens are worked on as a forest: one numpy row per pre-token, the
same tree shape for all rows of a size class, one merge of every row per step.
Longer ones get a tree of their own.

Around the merges a batch stays in Arrow columns: its distinct units are found
there, their ids are taken from a list column of the pre-tokens' ids, and texts
come back by taking the tokens' bytes.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelens.llm import common as C
from filelens.llm.pretokens import PATTERN, Splitter, binary_column, raw_column

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens whose ids a worker keeps; it starts afresh beyond that.
CACHE_UNITS = 300_000
#: Pre-tokens up to this many bytes are merged in the forest.
FOREST_BYTES = 64
_POS_BITS = 32
_MASK = (1 << _POS_BITS) - 1
_INF = np.int64(1) << 60


class Vocabulary:
    """Ranks of a tiktoken file: token bytes <-> id, and the pairs that merge."""

    def __init__(self, data: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        tokens = {i: t for t, i in self.ranks.items()}
        self.tokens = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.large_binary())
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        get, pairs = self.ranks.get, {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        self.pairs = pairs
        self._keys = np.array(sorted(pairs), dtype=np.int64)
        self._ranks = np.array([pairs[k] for k in self._keys.tolist()], dtype=np.int64)

    def leaf(self, left: np.ndarray, right: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Leaf values ``rank, position`` of pairs; ``_INF`` where none merges."""
        key = (left << 32) | right
        at = np.searchsorted(self._keys, key)
        at[at == len(self._keys)] = 0
        return np.where(self._keys[at] == key, (self._ranks[at] << _POS_BITS) | pos, _INF)


def merge_forest(words: list[bytes], width: int, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of ``words`` of at most ``width`` (a power of two) bytes, one
    after the other, and where each word's ids end."""
    n = len(words)
    lens = np.array([len(w) for w in words])
    raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(n, width)
    # one more column: the place after the last position, never a pair
    tok = np.full((n, width + 1), -1, dtype=np.int64)
    tok[:, :width] = vocab.byte_ids[raw]
    cols = np.arange(width)
    inside = cols < lens[:, None]
    tok[:, :width][~inside] = -1
    nxt = np.minimum(np.arange(1, width + 2), lens[:, None])
    prv = np.tile(np.arange(-1, width), (n, 1))
    tree = np.full((n, 2 * width), _INF)
    row, pos = np.nonzero(cols + 1 < lens[:, None])
    tree[row, width + pos] = vocab.leaf(tok[row, pos], tok[row, pos + 1], pos)
    for level in range(width.bit_length() - 2, -1, -1):
        a = 1 << level
        tree[:, a : 2 * a] = np.minimum(tree[:, 2 * a : 4 * a : 2], tree[:, 2 * a + 1 : 4 * a : 2])

    def put(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        node = leaf + width
        tree[rows, node] = value
        node = node >> 1
        for _ in range(width.bit_length() - 1):
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            node = node >> 1

    rows = np.arange(n)
    while True:
        root = tree[rows, 1]
        rows, root = rows[root < _INF], root[root < _INF]
        if not len(rows):
            break
        p, rank = root & _MASK, root >> _POS_BITS
        gone = nxt[rows, p]
        after = nxt[rows, gone]
        tok[rows, p], tok[rows, gone] = rank, -1
        nxt[rows, p], prv[rows, after] = after, p
        put(rows, gone, np.full(len(rows), _INF))
        last = after >= lens[rows]
        put(rows, p, np.where(last, _INF, vocab.leaf(rank, tok[rows, after], p)))
        before = prv[rows, p]
        r, b = rows[before >= 0], before[before >= 0]
        put(r, b, vocab.leaf(tok[r, b], tok[r, nxt[r, b]], b))
    live = tok[:, :width] >= 0
    return tok[:, :width][live].astype(np.int32), np.cumsum(live.sum(axis=1))


def merge_one(word: bytes, vocab: Vocabulary) -> list[int]:
    """The same merges for one long pre-token, with a tree of its own."""
    n, pairs, inf = len(word), vocab.pairs, int(_INF)
    width = 1 << max(1, (n - 1).bit_length())
    tok = vocab.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [inf] * (2 * width)

    def value(i: int) -> int:
        rank = pairs.get((tok[i] << 32) | tok[nxt[i]]) if nxt[i] < n else None
        return inf if rank is None else (rank << _POS_BITS) | i

    def put(i: int, v: int) -> None:
        i += width
        tree[i] = v
        i >>= 1
        while i:
            least = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == least:
                break
            tree[i] = least
            i >>= 1

    for i in range(n):
        tree[width + i] = value(i)
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])
    while tree[1] < inf:
        p, gone = tree[1] & _MASK, nxt[tree[1] & _MASK]
        tok[p], tok[gone] = tree[1] >> _POS_BITS, -1
        nxt[p] = nxt[gone]
        if nxt[p] < n:
            prv[nxt[p]] = p
        put(gone, inf)
        put(p, value(p))
        if prv[p] >= 0:
            put(prv[p], value(prv[p]))
    return [t for t in tok if t >= 0]


class Codec:
    """Encodes and decodes texts by one vocabulary."""

    def __init__(self, data: bytes, pattern: str = PATTERN):
        self.vocab = Vocabulary(data)
        self._split = Splitter(pattern)
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self._ids = pa.array([], pa.list_(pa.int32()))

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of new pre-tokens."""
        known, classes = [], {}
        for w in words:
            raw = w.encode()
            rank = self.vocab.ranks.get(raw)
            if rank is not None:  # a pre-token of the vocabulary is one token
                known.append((w, [rank]))
            elif len(raw) > FOREST_BYTES:
                known.append((w, merge_one(raw, self.vocab)))
            else:
                classes.setdefault(1 << (len(raw) - 1).bit_length(), []).append((w, raw))
        names, lists = [w for w, _ in known], [self._ids, pa.array([ids for _, ids in known], self._ids.type)]
        for width, group in classes.items():
            flat, ends = merge_forest([raw for _, raw in group], width, self.vocab)
            names += [w for w, _ in group]
            lists.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat)))
        self._place.update(zip(names, range(len(self._ids), len(self._ids) + len(names)), strict=True))
        self._ids = pa.concat_arrays(lists)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a column of texts without nulls, one after the other, and
        where each text's begin."""
        units, first = self._split.cut(texts.cast(pa.large_string()))
        units = units.dictionary_encode()
        words, first_word, place = self._split.tokens_of(units.dictionary)
        if len(self._place) > CACHE_UNITS:
            self._forget()
        if new := [w for w in set(words) if w not in self._place]:
            self._learn(new)
        at = np.fromiter(map(self._place.__getitem__, words), np.int64, len(words))
        by_word = self._ids.take(pa.array(at))
        first_id = by_word.offsets.to_numpy()[first_word]
        by_unit = pa.ListArray.from_arrays(pa.array(first_id), by_word.values)
        ids = by_unit.take(pa.array(place[units.indices.to_numpy()]))
        return ids.values.to_numpy(), ids.offsets.to_numpy()[first]

    def decode_column(self, ids: pa.Array, ends: np.ndarray) -> pa.Array:
        """The bytes that each row's ids stand for, as a binary column; row i has
        the ``ids`` from ``ends[i]`` to ``ends[i + 1]``."""
        taken = self.vocab.tokens.take(ids)
        if taken.null_count:
            raise KeyError("a token id that the vocabulary does not have")
        at, data = raw_column(taken)
        return binary_column(at[ends], data).cast(pa.binary())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        flat, ends = self.encode_column(pa.array(texts, pa.large_string()))
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, rows: list[np.ndarray]) -> list[bytes]:
        """The bytes that each row's ids stand for."""
        flat = np.concatenate([np.zeros(0, np.int32), *rows])
        return self.decode_column(pa.array(flat), np.cumsum([0, *map(len, rows)])).to_pylist()


def encode_decode(df: DataFrame, vocabulary_path: str, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",),
                  pattern: str = PATTERN, decoded: bool = True) -> DataFrame:
    """``keys``, ``token_ids`` (array of int) of every whole text and, with
    ``decoded``, the bytes ``decoded`` that the ids stand for.

    A null text is empty: no ids, no bytes.  Every input row gives one row,
    repeated rows and null keys too.  No special tokens.  The vocabulary is
    read on the driver (it has the size of a vocabulary) and broadcast.
    """
    shared = C.SharedFile.read(df.sparkSession, vocabulary_path)
    t, i, d = C.tag("t"), C.tag("i"), C.tag("d")
    rows = df.select(*keys, C.text_or_empty(text_col).alias(t))
    schema = T.StructType([*rows.drop(t).schema.fields, T.StructField(i, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add(d, T.BinaryType())

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = shared.made(Codec, pattern)
        flat, ends = codec.encode_column(batch.column(t))
        ids = pa.array(flat)
        names = [c for c in batch.schema.names if c != t]
        arrays = [*(batch.column(c) for c in names), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)]
        if decoded:
            arrays.append(codec.decode_column(ids, ends))
        return pa.RecordBatch.from_arrays(arrays, names=[*names, i, *([d] if decoded else [])])

    out = C.map_arrow(rows, fn, schema, size_of=t)
    cols = [*keys, F.col(i).alias("token_ids")]
    return out.select(*cols, F.col(d).alias("decoded")) if decoded else out.select(*cols)


def decode(df: DataFrame, vocabulary_path: str, ids_col: str = "token_ids", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and the bytes ``decoded`` of an array of token ids (null: empty).
    An id that the vocabulary does not have is an error."""
    shared = C.SharedFile.read(df.sparkSession, vocabulary_path)
    i, d = C.tag("i"), C.tag("d")
    rows = df.select(*keys, F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias(i))
    schema = T.StructType([*rows.drop(i).schema.fields, T.StructField(d, T.BinaryType())])

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = shared.made(Codec)
        names = [c for c in batch.schema.names if c != i]
        ends = batch.column(i).offsets.to_numpy()
        arrays = [*(batch.column(c) for c in names), codec.decode_column(batch.column(i).flatten(), ends - ends[0])]
        return pa.RecordBatch.from_arrays(arrays, names=[*names, d])

    return C.map_arrow(rows, fn, schema, size_of=i).select(*keys, F.col(d).alias("decoded"))


def with_digests(encoded: DataFrame, *more: F.Column) -> DataFrame:
    """Token count and digests of encoded rows, for comparison by value, and ``more``."""
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return encoded.select(
        *[c for c in encoded.columns if c not in ("token_ids", "decoded")],
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        *more,
    )


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again; digests of both."""
    import public_tokenizers

    docs = C.table(spark, sf_dir, "documents")
    return with_digests(encode_decode(docs, public_tokenizers.path(VOCABULARY)))
