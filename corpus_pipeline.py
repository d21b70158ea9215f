"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logbrook.llm.mixing import mixed_documents
from logbrook.llm.ordinal import grade_documents, train
from logbrook.llm.packing import pack_documents
from logbrook.llm.simhash import keep_one
from logbrook.llm.suffix_array import remove_repeats
from logbrook.session import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it learns from the labelled ones among them."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return grade_documents(docs, model).filter("kept").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of SimHash near-duplicates."""
    return keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 200 bytes that start in two places."""
    return remove_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, shard after shard: a row for each pass over a document and shard, cut to the words taken."""
    return mixed_documents(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in training sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("simhash_near_dedup", one_of_each),
    ("suffix_array_dedup", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL has neither the tokenizer nor the model; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
