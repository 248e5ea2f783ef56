"""A training corpus from ``documents``: quality, near-duplicates, personal data, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, as it keeps them; the last one
returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostlens.llm import mixing, neardup, packing, pii, quality
from hostlens.llm.common import row_hash, table, with_copies
from hostlens.llm.queries import pii_field, tokenizer_path
from hostlens.session import materialize


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"), "quality", folds=5, fold=0, threshold=0.3)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the smallest doc_id."""
    found = neardup.classes(docs).where("first").groupBy("doc_id", "_row").agg(F.lit(1).alias("copies"), F.count("*").alias("times"))
    return with_copies(docs, materialize(found, "pipeline-first"))


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.mask(docs, pii_field(spark))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    marked = docs.select("doc_id", "text", "source", row_hash(docs).alias("_row"))
    mix = mixing.balanced_mix(marked, weights=(5, 2, 1), most=3.0, carry=("_row",))
    return with_copies(docs, mix.groupBy("doc_id", "_row").agg(F.sum("copies").alias("copies"), F.count("*").alias("times")), mark="")


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), window=1024, end_id=0)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("personal_data", masked_documents),
    ("mixing", mixed_documents),
    ("packing", packed_documents),
]

#: Neither the classifier nor the similarity search can be stated in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
