"""Toxicity scores of whole texts by the network of :mod:`filelens.llm.gru`.

The network is fitted on a bounded sample of labelled texts (``MAX_TRAIN``
distinct ones, picked by hash from all labelled rows that may be learned
from), broadcast, and run over every window of every text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.llm import common as C
from filelens.llm.gru import Network, Scorer, train

#: Labelled texts that the network is fitted on, at most.
MAX_TRAIN = 3000
FOLDS = 5
THRESHOLD = 0.5


def held_out() -> F.Column:
    """The fold of a document that is never learned from; a null id is in no fold but may not be learned from either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """``text, toxic`` of at most ``most`` distinct labelled texts outside the
    held-out fold.  A text with several labels takes the more frequent one;
    null labels and texts count as no label.  The texts are picked by hash, so
    the sample is the same whatever the partitioning."""
    known = labels.where("toxic is not null").select("doc_id", "toxic").where(~held_out())
    texts = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_key"))
    voted = texts.join(known, "doc_id").groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"), F.round(F.avg("toxic")).cast("int").alias("toxic"))
    picked = voted.orderBy(F.xxhash64("text_key"), "text_key").limit(most)
    picked = picked.select(F.col("doc_id").alias("p_id"), F.col("text_key").alias("p_key"), "toxic")
    same = (docs.doc_id == F.col("p_id")) & (F.xxhash64(docs.text) == F.col("p_key"))
    return docs.join(F.broadcast(picked), same).select("p_key", "text", "toxic").dropDuplicates(["p_key"])


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> Network | None:
    """The network, or None where no labelled text may be learned from."""
    rows = sorted(training_sample(docs, labels, most).collect(), key=lambda r: r.p_key)
    return train([r.text for r in rows], [r.toxic for r in rows]) if rows else None


def score_toxicity(docs: DataFrame, network: Network | None, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Every row is scored by its whole text; a null, empty or letterless text
    gets the score of a text without words.  Without a network all scores are
    0.  Columns of ``docs`` are passed on; one of the two names is refused.
    """
    C.refuse(docs, score, predicted)
    if network is None:
        return docs.select("*", F.lit(0.0).alias(score), F.lit(0).alias(predicted))
    shared = C.SharedFile(docs.sparkSession, network.dump())
    t, s = C.tag("t"), C.tag("s")
    rows = docs.withColumn(t, C.text_or_empty())
    schema = docs.withColumn(s, F.lit(0.0)).schema

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.made(Scorer).scores(batch.column(t).to_pylist())
        names = [c for c in batch.schema.names if c != t]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scores, pa.float64())], names=[*names, s])

    out = C.map_arrow(rows, fn, schema, size_of=t)
    return out.select(*docs.columns, F.col(s).alias(score), (F.col(s) >= THRESHOLD).cast("int").alias(predicted))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the network, fitted on those of them that have
    labels, does not call toxic."""
    score, predicted = C.tag("score"), C.tag("predicted")
    network = fit(docs.select("doc_id", "text"), labels)
    return score_toxicity(docs, network, score, predicted).where(F.col(predicted) == 0).drop(score, predicted)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; learned from the labelled ones outside the held-out fold."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    network = fit(docs, C.table(spark, sf_dir, "labels"))
    return score_toxicity(docs, network).select("doc_id", held_out().alias("held_out"), "score", "predicted")
