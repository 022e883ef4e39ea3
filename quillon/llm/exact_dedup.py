"""Exact dedup: a tree merge of digest runs, in DataFrame operations only.

Every input partition makes a run: one entry for each digest it holds, with the
smallest identifier and the number of rows. In each round ``FAN_IN`` neighbouring
runs exchange their entries by digest and merge, so that after log_FAN_IN(LEAVES)
rounds one logical run is left, spread over the cluster by digest. No round
moves more entries than the one before, and a text repeated any number of
times is one entry a run.

Nulls and repeats: a null text counts as empty; a null identifier sorts after
all others, and stays only where its group has no other; of rows with the same identifier
and text one stays. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm.shared import matched, share

FAN_IN = 8
LEAVES = 512


def normalised(text: Column) -> Column:
    """White space runs of ASCII become one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t")).select(
        "id", F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").alias("bytes"), F.xxhash64("t").alias("check")
    )


def _key() -> Column:
    return F.struct(F.col("id").isNull().alias("none"), "id", "seq")


def tree_merge(rows: DataFrame, fan_in: int = FAN_IN, leaves: int = LEAVES) -> DataFrame:
    """One row a digest: ``keep`` (smallest identifier, as a struct) and ``n`` (rows).

    Entries merge only if their byte lengths and second hashes agree too; a
    digest shared by different texts would stay as two entries.
    """
    entry = ["digest", "bytes", "check"]
    merged = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(leaves)).alias("run"), *entry).agg(
        F.min(_key()).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    runs = leaves
    while runs > 1:
        runs = -(-runs // fan_in)
        merged = merged.groupBy(F.expr(f"run div {fan_in}").cast("int").alias("run"), *entry).agg(
            F.min("keep").alias("keep"), F.sum("n").alias("n")
        )
    return merged.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, keep_id, group_size, kept, text_sha256."""
    rows = share(_digested(docs, id_col, text_col).withColumn("seq", F.monotonically_increasing_id())).df
    merged = tree_merge(rows).select(
        F.col("digest").alias("d"), F.col("bytes").alias("b"), F.col("check").alias("c"), "keep", "n"
    )
    joined = rows.join(
        merged, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b")) & (F.col("check") == F.col("c"))
    )
    return joined.select(
        F.col("id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        (F.col("seq") == F.col("keep.seq")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = share(_digested(docs, id_col, text_col).withColumn("seq", F.monotonically_increasing_id())).df
    kept = tree_merge(rows).select(F.col("keep.seq").alias("seq"), F.lit(True).alias("stays"))
    fate = rows.select("id", "check", "seq").join(kept, "seq", "left").groupBy(F.col("id").alias("_id"), F.col("check").alias("_same")).agg(
        F.coalesce(F.bool_or("stays"), F.lit(False)).alias("stays"), F.count(F.lit(1)).alias("copies")
    )
    fate = share(fate.where("NOT stays OR copies > 1"))
    marked = docs.withColumn("_check", F.xxhash64(normalised(F.col(text_col))))
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_check") == F.col("_same"))
    single = matched(marked, fate, same, "left_anti")
    repeated = fate.df.where("stays")
    if repeated.isEmpty():
        return single.drop("_check")
    twice = marked.join(repeated, same, "left_semi").dropDuplicates([id_col, "_check"])
    return single.unionByName(twice).drop("_check")


OP9_SQL = """
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
