"""A training-data pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before
kept; its result is written as Parquet to the shared folder and read again.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.llm import bpe, common, decontamination, minhash, pii, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go; it learns from the labelled ones."""
    return toxicity.without_toxic(docs, common.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity 0.8."""
    return minhash.without_near_duplicates(docs, shingle_size=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words lies in benchmark passages go."""
    return decontamination.without_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is generalised or removed; all documents stay."""
    return pii.sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their number and the digests of ids and decoded bytes."""
    import public_tokenizers

    coded = bpe.encode_decode(docs, public_tokenizers.path(bpe.VOCABULARY))
    return bpe.with_digests(coded, F.col("token_ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("bpe", encode),
]

#: Trained models and sketches have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
