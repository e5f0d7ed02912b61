"""The corpus pipeline: toxicity, exact dedup, n-gram Jaccard join, mixing and packing over documents.

Each stage is an operator of ``auditloom.llm`` with its production parameters and takes what its
predecessor kept. All but the last return the columns of ``documents``; the last returns the place of
every piece of every document in its training sequence. No stage drops a document for any reason but
its own decision: its toxicity, an earlier equal or near copy, or the target of its source.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from auditloom.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from auditloom.llm.common import saved
from auditloom.llm.queries import remainder, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at or above the threshold go; the model learns from the labelled ones that are not held out."""
    return toxicity.clean_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder(4) != 2))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the one with the smallest doc_id stays."""
    return exact_dedup.distinct_documents(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word Jaccard 0.8 or more connect, the one with the smallest doc_id stays."""
    return ngram_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL expresses neither the classifier nor the tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs)
    return docs
