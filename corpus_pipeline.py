"""A training-data pipeline over ``documents``: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evigrid.llm import bpe_tree, language, mixing, simhash, toxicity
from evigrid.llm._common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels of these documents, does not call toxic."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected: those without letters or far from every centroid go."""
    return language.accepted(docs, language.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix of sources to target weights takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their count and the digests of the ids and of the decoded text."""
    return bpe_tree.encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]

#: Not expressible: learned models, fingerprints, random draws and byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
