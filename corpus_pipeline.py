"""From raw documents to packed training sequences.

Each stage takes the documents that the one before has kept, whole rows, as a stored table. Nulls, empty texts,
repeated rows and empty tables have the results that the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import language, mixing, packing, simhash
from shelfwise.llm.catalog import tokenizer
from shelfwise.llm.common import documents, prepared
from shelfwise.session import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages go."""
    prepared(spark)
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with fingerprints of three-word shingles within two bits one document stays."""
    prepared(spark)
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share of the mix says."""
    prepared(spark)
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, and the sequence and place of each."""
    prepared(spark)
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Language profiles, fingerprints and tokenizers have no SQL; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(prepared(spark), sf_dir)
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
