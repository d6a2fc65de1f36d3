"""A training corpus from raw documents: judge, deduplicate, pseudonymise, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import as_table, stored, with_row
from starloom.llm.jaccard_join import Rule, jaccard_classes
from starloom.llm.mixing import mix_sources
from starloom.llm.packing import pack_documents
from starloom.llm.pseudonyms import QUERY_KEY, pseudonymise
from starloom.llm.quality import judge_quality, trusted_ids


NEAR = Rule(shingle=5, num=4, den=5)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject; trusted text is what ``labels`` calls good."""
    trusted = trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge_quality(docs, trusted).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked sets of 5-word shingles, Jaccard 0.8 or more: the one with the smallest id.

    Null, empty and wordless texts are linked with nothing and stay. Of rows that tie in their id one
    stays. Columns of any name come through as they are.
    """
    docs, row = as_table(docs), "_row"
    while row in docs.columns:
        row += "_"
    stay = jaccard_classes(docs, rule=NEAR).where("_row = class_row").select(F.col("_row").alias(row))
    return with_row(docs, row).join(stay, row, "left_semi").select(*docs.columns)


def private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With pseudonyms for personal values."""
    return pseudonymise(docs, QUERY_KEY).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks, all sources at the same weight, in a global shuffle."""
    return mix_sources(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens; a repeated document has pieces for each repetition."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", private_values),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # signatures, Feistel networks and packing are beyond SQL; the tests hold stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
