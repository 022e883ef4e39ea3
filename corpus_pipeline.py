"""The corpus pipeline: toxicity, exact dedup, near-dedup, mixing and packing, in this order.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of documents: after mixing there is a row for each pass over a document, in the order of the
schedule, and where a source's target ends inside a document, the row holds the words up to there. Packing gives a row
for each piece of a row, with its text; ``row`` tells the passes over a document apart (see quillon.llm.packing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from quillon.llm.shared import share


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer does not reject."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return near_dedup.keep_representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once for each pass over them."""
    return mixing.mixed_corpus(docs).drop("mix_pass", "mix_slot")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in length buckets and batches."""
    return packing.packed(docs, with_text=True)


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", unique),
    ("near_dedup", distinct),
    ("mixing", mixed),
    ("packing", packed),
]

#: The learned scorer and the dynamic programme are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = share(stage(spark, docs, sf_dir)).df
    return STAGES[-1][1](spark, docs, sf_dir)
