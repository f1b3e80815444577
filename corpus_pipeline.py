"""A training corpus from `documents`: quality, near copies, repeated text, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltmart.llm import packing, quality, simhash, substrings
from voltmart.llm.queries import tokenizer_file
from voltmart.session import cut_lineage, tune


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects; it learns from `labels` outside its fold."""
    tune(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that op1_simhash links: the one of smallest doc_id."""
    tune(spark)
    return simhash.keep_one(docs, simhash.SHINGLE_WORDS)


def without_repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that occur elsewhere; documents of which nothing remains go."""
    tune(spark)
    return substrings.strip_repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in training sequences."""
    tune(spark)
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each_group),
    ("repeated_text", without_repeated_text),
    ("packing", packed),
]

# SQL cannot express fingerprints, learned scores or a tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each one returns is written and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
