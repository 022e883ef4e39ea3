"""Text encoders: columns of text to columns of vectors.

``hashing`` is the default: signed hashed counts of the first word tokens, deterministic and native. A model can take
its place: any function of a text column that gives an array of floats, such as ``batched`` makes
from a callable over lists of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.text import tokens

MOST_TOKENS = 128


def hashing(text: Column, size: int = 64, most: int = MOST_TOKENS) -> Column:
    """Signed counts of hashed tokens in ``size`` slots."""
    codes = F.transform(F.slice(tokens(text), 1, most), lambda t: F.xxhash64(t))
    slots = F.transform(codes, lambda h: F.struct(F.pmod(h, F.lit(size)).alias("at"), F.when(F.pmod(F.shiftright(h, 32), F.lit(2)) == 0, 1.0).otherwise(-1.0).alias("by")))
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda k: F.aggregate(F.filter(slots, lambda s: s["at"] == k), F.lit(0.0), lambda a, s: a + s["by"]).cast("float"),
    )


def batched(encode: Callable[[list[str]], list[list[float]]], batch: int = 32) -> Callable[[Column], Column]:
    """An encoder column from a function over lists of texts; texts go in by length, in batches of bounded size."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            order = part.fillna("").str.len().sort_values(ascending=False, kind="stable").index
            out: dict = {}
            for k in range(0, len(order), batch):
                some = order[k : k + batch]
                out.update(zip(some, encode([part[i] or "" for i in some]), strict=True))
            yield pd.Series([out[i] for i in part.index], index=part.index)

    return run
