"""The pipeline over documents: each stage works on all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from glyphmill.llm import bpe, mixing, neardup, privacy, quality
from glyphmill.llm.plan import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; texts of the others lose their frequent lines.

    A null or empty text has no words and goes. Repeated rows are judged alike; an empty table stays empty.
    """
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by links, the one with the smallest id stays.

    Repeated rows and equal texts are one group; an empty table stays empty.
    """
    return neardup.first_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that reveal it are generalised in the texts."""
    return privacy.sanitised(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the text they decode to: ``token_ids`` and ``decoded``.

    Input columns of these two names are replaced. A null text has no ids; every row gives one.
    """
    names = [c for c in docs.columns if c not in ("token_ids", "decoded")]
    rows = bpe.tokenised(docs, bpe.default_vocabulary())
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in names], F.col("ids").alias("token_ids"), "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: No SQL: near duplicates, dependent rounding and the encoder are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
