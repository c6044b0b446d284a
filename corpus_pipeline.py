"""A training corpus in five stages; each takes (spark, docs, sf_dir) and returns a DataFrame.

toxicity, quality: documents that the classifier rejects go. near_dedup: one document of each class
stays. mix: documents are repeated or left out to the target weights of their sources. pack: the
pieces of all that is left, with their places in sequences of 2048 tokens.

All stages but the last return the columns of documents. Each is written to the shared folder and
read again before the next begins.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, near_dedup, packing, quality, toxicity
from tidemark.llm.common import bound_batches, materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; null and empty texts have no evidence and stay."""
    bound_batches(spark)
    return toxicity.clean_only(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the quality threshold."""
    bound_batches(spark)
    return quality.good_only(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the least id; rows without an id stay."""
    bound_batches(spark)
    return near_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it, which may be not at all."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places; null texts are empty, an empty table has no pieces."""
    bound_batches(spark)
    return packing.pack(
        docs,
        vocabulary=public_tokenizers.path("byte_bpe_50k.json"),
        ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: The classifiers, the sampled sketches and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
