"""The corpus pipeline: raw documents to packed training sequences.

Each stage calls one operator of ``creditweave.llm`` on all that the stage
before it kept. Rows are documents by ``doc_id``; rows that share it are
judged together. Null text counts as empty: it has no language and goes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from creditweave.llm import exact_dedup, language_id, mixing, packing, simhash
from creditweave.llm.common import documents
from creditweave.session import cut_lineage

# A document whose best language has a lower mean probability over its bytes is rejected.
LEAST_SCORE = 0.4
TOKENIZER = "word_bpe_49k.json"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language; those without letters or of none go."""
    return language_id.accepted(docs, LEAST_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document of the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at four or fewer bits, the one of the smallest id."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that the shares of sources, languages and topics meet their targets."""
    return mixing.sampled(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned labels, fingerprints and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written as Parquet and reread."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
