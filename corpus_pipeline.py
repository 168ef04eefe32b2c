"""From documents to training sequences: quality, near duplicates, personal data, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read as the next one's
docs. All but the last return the columns of documents. Texts of any length pass whole; further columns may have any
names; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard_join, mixing, packing, pii, quality
from tidemark.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules don't reject.

    Null and empty texts go, as they fail the base; repeated rows go or stay together; equal posteriors get equal verdicts.
    """
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at a similarity of 0.8 or more, the one with the smallest doc_id.

    Null ids come last; of several texts under the smallest one, that of the smallest hash stays; of rows that share
    doc_id and text one stays. Null texts and those without a word link with nothing and all stay.
    """
    return jaccard_join.keep_one(docs, words=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that reveal it, generalised in texts; no row goes. Null texts stay null, repeated rows change alike."""
    return pii.redact(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mixture takes it.

    Null texts have no words and null sources are one source; repeated rows of one doc_id and text share one draw.
    """
    return mixing.mix(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequences and offsets; a null or empty text is its end id alone, repeated rows are packed each."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixture", source_mixture),
    ("sequences", sequences),
]

#: Shingle hashes, fitted rules and a tokenizer aren't within SQL's reach; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
