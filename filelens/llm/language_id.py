"""Language identification in two steps.

A linear support vector machine for each family (one against the rest) picks
the family; inside it, one linear machine for every two languages votes.  The
features are hashed character n-grams (1 to 3) of the whole text.  The machines
are fitted in numpy on a bounded, stratified sample of labelled texts.
"""

from __future__ import annotations

import io
import json
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelens.llm import common as C

FOLDS, HELD_OUT = 4, 2
#: Labelled texts that are learned from, at most; each is learned from whole.
MAX_TRAIN = 2400
#: Shares that a language's labelled texts are dealt to before the least hashes are taken of all.
SHARES = 64
FEATURES = 4096
STEPS, RATE, DECAY = 250, 0.2, 1e-4
UNKNOWN = "und"

# Families of ISO 639-1 codes; any other value is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "turkic": "az kk ky tr uz",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms tl",
    "chinese": "yue zh",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.split("-")[0].split("_")[0].lower(), lang)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A unit row of n-gram features for each text, and whether it has a letter."""
    out, has = np.zeros((len(texts), FEATURES), np.float32), np.zeros(len(texts), dtype=bool)
    table = _letter_table()
    for i, text in enumerate(texts):
        if not text:
            continue
        c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = table[c]
        if not letter.any():
            continue
        has[i] = True
        # every run of other characters counts as one space
        c = np.where(letter, c, np.uint32(32))[letter | np.r_[True, letter[:-1]]]
        c = np.r_[np.uint32(32), c, np.uint32(32)]
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
        three = (two[:-1] ^ (c[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        row = sum(np.bincount((h >> np.uint32(20)).astype(np.int64), minlength=FEATURES) for h in (one, two, three))
        row = np.sqrt(row.astype(np.float32))
        out[i] = row / np.linalg.norm(row)
    return out, has


def _machine(X: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine, y is +1 or -1:
    squared hinge loss, both sides of equal weight, by gradient steps with momentum."""
    X1 = np.concatenate([X, np.ones((len(X), 1), np.float32)], axis=1)
    side = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, speed = np.zeros(X1.shape[1], np.float32), np.zeros(X1.shape[1], np.float32)
    for _ in range(STEPS):
        slack = np.maximum(0, 1 - y * (X1 @ w))
        g = -2 * X1.T @ (side * y * slack) + DECAY * w
        speed = 0.9 * speed - RATE * g
        w += speed
    return w.astype(np.float32)


class Machines:
    """Family machines and, inside each family, a machine for every two languages."""

    def __init__(self, langs: list[str], W: np.ndarray):
        self.langs, self.W = langs, W
        self.families = sorted({family_of(x) for x in langs})
        self.members = [[i for i, x in enumerate(langs) if family_of(x) == f] for f in self.families]
        self.pairs = [p for m in self.members for p in combinations(m, 2)]

    @classmethod
    def fit(cls, texts: list[str], langs: list[str]) -> Machines:
        return cls.fit_features(features(texts)[0], langs)

    @classmethod
    def fit_features(cls, X: np.ndarray, langs: list[str]) -> Machines:
        made = cls(sorted(set(langs)), np.zeros((FEATURES + 1, 0), np.float32))
        of = np.array([made.langs.index(x) for x in langs])
        rows = [_machine(X, np.where(np.isin(of, m), 1.0, -1.0).astype(np.float32)) for m in made.members] if len(made.members) > 1 else []
        for a, b in made.pairs:
            both = (of == a) | (of == b)
            rows.append(_machine(X[both], np.where(of[both] == a, 1.0, -1.0).astype(np.float32)))
        made.W = np.stack(rows, axis=1) if rows else made.W
        return made

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        X, has = features(texts)
        margins = X @ self.W[:-1] + self.W[-1]
        sure = 1 / (1 + np.exp(-3 * margins))
        n_fam = len(self.families) if len(self.families) > 1 else 0
        family = margins[:, :n_fam].argmax(axis=1) if n_fam else np.zeros(len(texts), int)
        score = sure[np.arange(len(texts)), family] if n_fam else np.ones(len(texts))
        votes = np.zeros((len(texts), len(self.langs)))
        for j, (a, b) in enumerate(self.pairs):
            votes[:, a] += sure[:, n_fam + j]
            votes[:, b] += 1 - sure[:, n_fam + j]
        lang = np.zeros(len(texts), int)
        for f, members in enumerate(self.members):
            mine = np.flatnonzero(family == f)
            best = votes[np.ix_(mine, members)].argmax(axis=1)
            lang[mine] = np.array(members)[best]
            if len(members) > 1:
                score[mine] *= votes[mine, lang[mine]] / (len(members) - 1)
        return [self.langs[x] if ok else UNKNOWN for x, ok in zip(lang, has, strict=True)], np.where(has, score, 0.0)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, W=self.W, langs=np.frombuffer(json.dumps(self.langs).encode(), np.uint8))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Machines:
        with np.load(io.BytesIO(data)) as f:
            return cls(json.loads(f["langs"].tobytes().decode()), f["W"])


def held_out() -> F.Column:
    """The fold that is never learned from; a null id is in it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def training_sample(docs: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """``text, lang`` of at most ``most`` distinct labelled texts outside the
    held-out fold, as many of each language as there are, picked by hash."""
    rows = docs.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & ~held_out())
    rows = rows.select("doc_id", "lang", F.xxhash64("text").alias("text_key"))
    n = rows.agg(F.count_distinct("lang")).first()[0]
    once = rows.groupBy("lang", "text_key").agg(F.min("doc_id").alias("doc_id"))
    each = max(1, most // max(1, n))
    order = [F.xxhash64("text_key"), F.col("text_key")]
    # a language of most texts is dealt out first: its least hashes are among the least of each share
    share = F.pmod(F.xxhash64("text_key", F.lit("share")), F.lit(SHARES))
    picked = once.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= each)
    picked = picked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= each)
    picked = picked.select(F.col("lang").alias("p_lang"), F.col("text_key").alias("p_key"), F.col("doc_id").alias("p_id"))
    same = (docs.doc_id == F.col("p_id")) & (F.xxhash64(docs.text) == F.col("p_key"))
    # at most `most` rows
    return docs.join(F.broadcast(picked), same).select("p_lang", "p_key", "text").dropDuplicates(["p_lang", "p_key"])


def fit(docs: DataFrame, most: int = MAX_TRAIN) -> Machines | None:
    """The machines, or None where no labelled text may be learned from.

    The sampled texts are read whole in tasks; what comes to the driver is one
    row of ``FEATURES`` numbers for each."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        X, _ = features(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("p_lang"), batch.column("p_key"), pa.array([x.tobytes() for x in X], pa.binary())],
                                          names=["p_lang", "p_key", "x"])

    sample = C.map_arrow(training_sample(docs, most), fn, "p_lang string, p_key bigint, x binary", size_of="text")
    rows = sorted(sample.collect(), key=lambda r: (r.p_lang, r.p_key))
    X = np.stack([np.frombuffer(r.x, np.float32) for r in rows]) if rows else None
    return Machines.fit_features(X, [r.p_lang for r in rows]) if rows else None


def identify(docs: DataFrame, machines: Machines | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) for every row.

    A null text or one without a letter gets ``und`` and 0, and so does every
    text where nothing could be learned.  Columns of ``docs`` are passed on;
    one of the two names is refused.
    """
    C.refuse(docs, "lang_pred", "score")
    if machines is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    shared = C.SharedFile(docs.sparkSession, machines.dump())
    t, p, s = C.tag("t"), C.tag("p"), C.tag("s")
    schema = T.StructType([*docs.schema.fields, T.StructField(p, T.StringType()), T.StructField(s, T.DoubleType())])

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = shared.made(Machines.load).predict(batch.column(t).to_pylist())
        names = [c for c in batch.schema.names if c != t]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, p, s])

    out = C.map_arrow(docs.withColumn(t, C.text_or_empty()), fn, schema, size_of=t)
    return out.select(*docs.columns, F.col(p).alias("lang_pred"), F.col(s).alias("score"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; learned from those outside the held-out fold."""
    docs = C.table(spark, sf_dir, "documents")
    machines = fit(docs)
    return identify(docs.select("doc_id", "text"), machines).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
