"""Token counts by rank-synchronous array merging.

A batch's distinct pre-tokens lie one after the other in one numpy array of
symbols with sequence boundaries (a ragged array).  In each round every
sequence finds its lowest-ranked adjacent pair (a segmented minimum) and all
sequences merge theirs at once, each occurrence from left to right.  A pair
made by a merge always ranks after the merge itself, so merging all
occurrences of a sequence's lowest pair together gives the library's result.
What survives is counted.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelens.llm import common as C
from filelens.llm.pretokens import Splitter, byte_alphabet

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Units, and pre-tokens, whose counts a worker keeps; it starts afresh beyond that.
CACHE_UNITS = 400_000
_NONE = np.int64(1) << 40


@dataclass
class PairTable:
    """Adjacent pairs that merge: sorted keys, their ranks and results."""

    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray

    @classmethod
    def of(cls, pairs: dict[tuple[int, int], tuple[int, int]]) -> PairTable:
        keys = np.array([(a << 32) | b for a, b in pairs] or [0], dtype=np.int64)
        ranks = np.array([r for r, _ in pairs.values()] or [_NONE], dtype=np.int64)
        results = np.array([i for _, i in pairs.values()] or [0], dtype=np.int64)
        order = np.argsort(keys)
        return cls(keys[order], ranks[order], results[order])

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``_NONE`` where the pair does not merge) and place in the table."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], _NONE), at


class Counter:
    """Counts symbols of texts by a JSON vocabulary (byte-level BPE)."""

    def __init__(self, vocabulary: bytes):
        spec = json.loads(vocabulary)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("a byte-level BPE vocabulary without normalizer and prefix space is needed")
        if model.get("ignore_merges") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("this vocabulary asks for rules that are not supported")
        vocab = model["vocab"]
        self._bytes = np.full(256, -1, dtype=np.int64)
        for char, byte in byte_alphabet().items():
            self._bytes[byte] = vocab[char]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self._pairs = PairTable.of({(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)})
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, added))) if added else None
        self._split = Splitter()
        self._cache: dict[str, int] = {}
        self._words: dict[str, int] = {}

    def symbols(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols left of each word once no pair merges."""
        lens = np.array([len(w) for w in words], dtype=np.int64)
        counts = lens.copy()
        sym = self._bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(words)), lens)
        ranks = np.full(len(sym), _NONE)
        place = np.zeros(len(sym), dtype=np.int64)

        def rate(at: np.ndarray) -> None:
            at = at[at < len(sym) - 1]
            ranks[at], place[at] = self._pairs.find(sym[at], sym[at + 1])
            ranks[at[seq[at] != seq[at + 1]]] = _NONE

        if len(sym):
            rate(np.arange(len(sym)))
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            sizes = np.diff(np.r_[starts, len(sym)])
            low = np.minimum.reduceat(ranks, starts)
            low_of = np.repeat(low, sizes)
            live = low_of < _NONE
            hits = np.flatnonzero((ranks == low_of) & live)
            if not len(hits):
                break
            # in a run of hits (one symbol repeated) every second one merges
            first = np.r_[True, hits[1:] != hits[:-1] + 1]
            run_start = np.maximum.accumulate(np.where(first, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - run_start) % 2 == 0]
            sym[hits] = self._pairs.results[place[hits]]
            keep = live
            keep[hits + 1] = False
            np.subtract.at(counts, seq[hits], 1)
            new_at = np.cumsum(keep) - 1
            changed = new_at[hits]
            sym, seq, ranks, place = sym[keep], seq[keep], ranks[keep], place[keep]
            ranks[changed] = _NONE  # a merged symbol that is now last keeps no pair
            again = np.zeros(len(sym), dtype=bool)
            again[changed] = True
            again[changed[changed > 0] - 1] = True
            rate(np.flatnonzero(again))
        return counts

    def _learn(self, units: set[str]) -> None:
        for cache in (self._cache, self._words):
            if len(cache) > CACHE_UNITS:
                cache.clear()
        new = [u for u in units if u not in self._cache]
        if not new:
            return
        parts = [self._split.tokens(u) for u in new]
        words = [t for t in {t for p in parts for t in p} if t not in self._words]
        self._words.update(zip(words, self.symbols([w.encode() for w in words]).tolist(), strict=True))
        get = self._words.__getitem__
        self._cache.update((u, get(p[0]) if len(p) == 1 else sum(map(get, p))) for u, p in zip(new, parts, strict=True))

    def count(self, texts: list[str]) -> list[int]:
        rows, seen = [], set()
        for text in texts:
            parts = self._added.split(text) if self._added else [text]
            units = self._split.units(parts[0])
            for p in parts[1:]:
                units += self._split.units(p)
            rows.append((len(parts) - 1, units))
            seen.update(units)
        self._learn(seen)
        get = self._cache.__getitem__
        return [extra + sum(map(get, units)) for extra, units in rows]


def count_tokens(df: DataFrame, vocabulary_path: str, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text.

    A null text counts as empty: 0 bytes, 0 tokens.  Every input row gives one
    row, repeated rows and null keys too.  Special strings inside a text count
    as one token each, as the tokenizers library does by default.  The file is
    read on the driver (its size is that of a vocabulary) and broadcast.
    """
    shared = C.SharedFile.read(df.sparkSession, vocabulary_path)
    n, b, t = C.tag("n"), C.tag("b"), C.tag("t")
    rows = df.select(*keys, C.text_or_empty(text_col).alias(t)).withColumn(b, F.octet_length(t).cast("bigint"))
    schema = rows.drop(t).schema.add(n, T.LongType())

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = shared.made(Counter).count(batch.column(t).to_pylist())
        cols = [batch.column(c) for c in batch.schema.names if c != t]
        return pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], names=[c for c in batch.schema.names if c != t] + [n])

    out = C.map_arrow(rows, fn, schema, size_of=t)
    return out.select(*keys, F.col(b).alias("n_bytes"), F.col(n).alias("n_tokens"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole document; ``over_limit`` above 512 tokens."""
    import public_tokenizers

    docs = C.table(spark, sf_dir, "documents")
    out = count_tokens(docs, public_tokenizers.path(VOCABULARY))
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)
