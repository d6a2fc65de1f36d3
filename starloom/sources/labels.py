"""Code mappings out of free-text label documents.

A document is a series of paragraphs split by ``*``. A paragraph with ``=`` in
it lists ``code = 'label'`` pairs for the first name in it that starts with the
given prefix.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions import collapse_whitespace, extract_pairs, strip_quotes
from starloom.sources.files import read_whole_text


def label_pairs(documents: DataFrame, text: str = "value", prefix: str = "i94") -> DataFrame:
    """(mapping, code, label) rows; left of ``=`` is the code."""
    paragraphs = documents.select(
        F.explode(F.split(collapse_whitespace(text), r"\*")).alias("paragraph")
    ).filter(F.col("paragraph").contains("="))
    named = paragraphs.select(
        F.regexp_extract("paragraph", rf"(?i)({prefix}\S*)", 1).alias("mapping"), "paragraph"
    ).filter(F.col("mapping") != "")
    pairs = named.select("mapping", F.explode(extract_pairs("paragraph")).alias("pair"))
    return pairs.select(
        "mapping",
        strip_quotes("pair.code").alias("code"),
        strip_quotes("pair.label").alias("label"),
    )


def label_mappings(spark: SparkSession, path: str, prefix: str = "i94") -> DataFrame:
    return label_pairs(read_whole_text(spark, path), "value", prefix)


def mapping_for(pairs: DataFrame, mapping: str) -> DataFrame:
    """One mapping as (code, label), asked for by its extracted name, any case."""
    return pairs.filter(F.lower("mapping") == mapping.lower()).select("code", "label")


def inline_mapping(spark: SparkSession, labels: Mapping[str, str]) -> DataFrame:
    """A short list of codes given in code, as (code, label).

    Spark knows the size of this plan. A frame made from Python rows has none, and
    Spark would shuffle a large table by the code to join it.
    """
    rows = [F.struct(F.lit(c).alias("code"), F.lit(v).alias("label")) for c, v in labels.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))
