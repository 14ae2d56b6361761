"""A corpus from raw documents: quality rules, near duplicates, decontamination, source mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet before the next one reads it. All
but the last return the columns of documents; the last returns a row for each document in the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.llm.decontamination import clean_documents
from waybill.llm.jaccard import distinct_documents
from waybill.llm.mixing import mixed_documents
from waybill.llm.quality import kept_documents
from waybill.llm.shared import Landing
from waybill.llm.tokens import token_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio."""
    return kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of five-word shingles."""
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not with other numbers or names either."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and the place of each document in them."""
    import public_tokenizers

    return token_table(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_files),
]

ORACLE_SQL = None  # hashed statistics and token ids are no SQL; tests/llm checks the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    landing = Landing(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = landing.land(docs, f"stage-{i}")
    return docs
