"""From raw documents to token ids: language ID, exact and near deduplication,
mixing and BPE encoding, each with its operator of ``quietude.llm``.

Every stage takes the rows its predecessor kept. All but the last return the
columns of ``documents``; a document that the mix takes twice is there twice
with the words of each pass. Empty tables, NULLs and repeated rows are as each
operator defines them; documents without text end at the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quietude.llm import bpe, exact_dedup, jaccard_join, language_id, mixing
from quietude.llm.common import stored, table
from quietude.llm.queries import BYTE_BPE


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language."""
    return language_id.keep_known(docs, language_id.fit(docs, F.lit(True)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the largest id of each text (A-Z lower-cased)."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles at 0.8 or more."""
    return jaccard_join.keep_one(docs, percent=80, words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's words up to its target."""
    mixed = mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, cap=2.0)
    return mixed.withColumn("n_chars", F.length("text").cast("long"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document's words."""
    coded = bpe.encode(docs, public_tokenizers.path(BYTE_BPE), keep=("lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: The language model, the draws and the merges are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
