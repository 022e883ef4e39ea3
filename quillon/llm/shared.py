"""Tables in the shared folder, and distributed running totals."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.session import Step

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Keys (a few numbers each) are broadcast up to this many rows, and joined by a shuffle beyond.
BROADCAST_ROWS = 1_000_000


@contextmanager
def _cleaned(spark: SparkSession):
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def share(df: DataFrame) -> Step:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage and survives lost executors. Spark removes the
    shuffle files of the finished write, and the table goes with the driver.
    """
    with _cleaned(df.sparkSession):
        return Step(df, "table")


def matched(rows: DataFrame, keys: Step, on, how: str) -> DataFrame:
    """``rows`` joined with a written table of keys, which is broadcast if its size allows."""
    few = keys.df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(keys.df) if few else keys.df, on, how)


def running_total(
    df: DataFrame, keys: list[str], order: list[str], digest: str, amount: Column, rows: int, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows of the same ``keys`` that come before in ``order``.

    ``order`` starts with the binary ``digest`` column, spread evenly over its
    values. Its leading bits cut each key into bins of a bounded size, so one
    key may hold any share of the rows: bins are summed first, and only bin sums are
    scanned per key. ``rows`` is the size of the largest key.
    """
    digits = 1
    while 16**digits * 20_000 < rows and digits < 12:
        digits += 1
    binned = df.withColumn("_bin", F.substring(F.hex(digest), 1, digits)).withColumn("_amount", amount)
    sums = binned.groupBy(*keys, "_bin").agg(F.sum("_amount").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_bin", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(k).alias(f"_{k}_b") for k in keys], F.col("_bin").alias("_bin_b"), "_start")
    same = F.col("_bin") == F.col("_bin_b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}_b"))
    return (
        binned.withColumn("_own", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
        .join(sums, same)
        .withColumn(out, F.col("_start") + F.col("_own"))
        .drop("_bin", "_bin_b", "_amount", "_own", "_start", *[f"_{k}_b" for k in keys])
    )
