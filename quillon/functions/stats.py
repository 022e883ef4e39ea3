"""Distribution statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_POINTS = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def distribution(x: Column) -> Column:
    """n, mean, population std, min, percentiles (linear interpolation) and max of the non-null values, as a struct."""
    at = F.percentile(x, F.array(*[F.lit(p) for p in _POINTS.values()]))
    return F.struct(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"),
        *[F.get(at, F.lit(i)).alias(name) for i, name in enumerate(_POINTS)],
        F.max(x).alias("max"),
    )


def score_distribution(df: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """One row a column (and key): its distribution."""
    wide = df.groupBy(*keys).agg(*[distribution(F.col(c).cast("double")).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("d")) for c in columns])).alias("r")
    return wide.select(*keys, rows).select(*keys, "r.metric", "r.d.*")


def describe_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """count, mean, sample std, min, median, p90, p95 and max of ``value`` by ``key``."""
    at = F.percentile(value, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.95)))
    return df.groupBy(key).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"),
        at.alias("at"), F.max(value).alias("max"),
    ).select(key, "n", "mean", "std", "min", F.get("at", F.lit(0)).alias("p50"), F.get("at", F.lit(1)).alias("p90"), F.get("at", F.lit(2)).alias("p95"), "max")


def column_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) of every column, in one pass; NaN counts as missing."""
    kinds = dict(df.dtypes)
    present = [F.count(F.when(F.col(f"`{c}`").isNotNull() & ~F.isnan(c), 1) if kinds[c] in ("double", "float") else F.col(f"`{c}`")).alias(c) for c in df.columns]
    one = df.agg(*present)
    rows = [F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.col(f"`{c}`").alias("non_null")) for c in df.columns]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
