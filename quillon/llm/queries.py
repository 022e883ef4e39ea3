"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import ann, exact_dedup, html_wrapper, license_scan, mixing, near_dedup, packing, suffix_dedup, toxicity, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(_table(spark, sf_dir, "documents")).drop("first_slot", "n_slots")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extracted(_table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_packing, op3_mixing, op4_toxicity, op5_url_filter, op6_suffix_dedup, op7_html_extraction, op8_license_scan, op9_exact_dedup, op10_nearest_neighbours)}

ORACLES = {"op1_near_dedup": near_dedup.OP1_SQL, "op5_url_filter": url_filter.OP5_SQL, "op3_mixing": mixing.OP3_SQL, "op6_suffix_dedup": suffix_dedup.OP6_SQL, "op9_exact_dedup": exact_dedup.OP9_SQL}
