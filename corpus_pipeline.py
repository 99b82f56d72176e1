"""From raw documents to packed sequences: five stages, each over all that the one before kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywell.llm import packing, pii, quality, simhash, toxicity
from tallywell.llm.catalog import make_importable
from tallywell.llm.common import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, learned from the labelled ones among them."""
    make_importable(spark)
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the perplexity band of their language."""
    make_importable(spark)
    return quality.keep_good(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    make_importable(spark)
    return simhash.keep_one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    make_importable(spark)
    return pii.mask_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    make_importable(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack),
]

#: Neighbour votes, language models and tokens have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
