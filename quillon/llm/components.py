"""Connected components of a link table by alternating large-star and small-star rounds.

Each round writes its links to the shared folder, so lineage stays short and lost
executors are survived; no links reach the driver. A node of any degree is an
aggregate with map-side combine and a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.shared import share

MOST_ROUNDS = 60
_PRINT = ("count(1)", "bit_xor(xxhash64(a, b))", "bit_xor(xxhash64(b, a))")


def _star(links: DataFrame, upward: bool) -> DataFrame:
    """Large star: a node's larger neighbours join its smallest one; small star: its smaller ones do."""
    if upward:
        near = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = near.join(least, "a")
    if upward:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node reachable."""
    table = share(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    print_of = table.df.selectExpr(*_PRINT).first()
    for _ in range(MOST_ROUNDS):
        new = share(_star(_star(table.df, True), False))
        table.drop()
        table, before, print_of = new, print_of, new.df.selectExpr(*_PRINT).first()
        if print_of == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = table.df.select(F.col("b").alias("node")).distinct()
    return table.df.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
