"""Packing into length buckets whose bounds minimise padding.

Texts longer than ``MOST_TOKENS`` are cut into pieces of that many tokens and a rest; the
histogram of piece lengths then has at most ``MOST_TOKENS`` entries, whatever the size
of the corpus. Dynamic programming over it finds the bounds of at most ``BUCKETS``
buckets with the least padding in all. Inside a bucket the pieces, shuffled by a hash of identifier, piece and row, so
that copies of a text part, fill batches of ``BATCH_TOKENS`` padded tokens.

Nulls and repeats: a null or empty text has no piece and is in no bucket (one row, with
null bucket and batch); repeated rows are pieces of their own. An empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.kernels import row_slices, text_buffer, words
from quillon.llm.shared import running_total, share

MOST_TOKENS = 4096
BUCKETS = 16
BATCH_TOKENS = 65_536


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets with the least total padding.

    cost(i, j) of one bucket over the lengths i..j pads all to lengths[j]. It
    satisfies the quadrangle inequality, so best splits are monotone and each layer
    takes O(n log n) by divide and conquer.
    """
    n = len(lengths)
    if n == 0:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    words = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    layer = lengths * rows[1:] - words[1:]
    splits = []
    for _ in range(1, min(buckets, n)):
        new, cut = np.zeros(n), np.zeros(n, dtype=np.int64)
        todo = [(0, n - 1, 0, n - 1)]
        while todo:
            a, b, lo, hi = todo.pop()
            if a > b:
                continue
            mid = (a + b) // 2
            i = np.arange(lo, min(mid, hi) + 1)  # the last bucket holds the lengths i..mid
            before = np.where(i > 0, layer[i - 1], 0.0)
            cost = before + lengths[mid] * (rows[mid + 1] - rows[i]) - (words[mid + 1] - words[i])
            k = int(np.argmin(cost))
            new[mid], cut[mid] = cost[k], i[k]
            todo += [(a, mid - 1, lo, int(i[k])), (mid + 1, b, int(i[k]), hi)]
        splits.append(cut)
        layer = new
    bounds, j = [], n - 1
    for cut in reversed(splits):
        if j < 0:
            break
        bounds.append(int(lengths[j]))
        j = int(cut[j]) - 1
    if j >= 0:
        bounds.append(int(lengths[j]))
    return sorted(bounds)


def pieces_of(docs: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(id, row, piece, first_token, n_tokens, text), at least one row a document; ``row`` tells rows of one id apart."""

    def cut(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for a, b in row_slices(offsets):
                own, raw = offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]]
                starts, ends, first = words(raw, own)
                sizes = np.diff(first)
                pieces = np.maximum(1, -(-sizes // most))
                row = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                n = np.minimum(sizes[row] - piece * most, most)
                lo = first[row] + piece * most
                some = n > 0
                texts = [raw[starts[i] : ends[i + k - 1]].tobytes().decode() if k else "" for i, k in zip(lo, n, strict=True)]
                at = pa.array(a + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(piece), pa.array(np.where(some, piece * most, 0)), pa.array(n), pa.array(texts, pa.string())],
                    names=["id", "row", "piece", "first_token", "n_tokens", "text"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return read.mapInArrow(cut, f"id {kind}, row long, piece long, first_token long, n_tokens long, text string")


def packed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    most: int = MOST_TOKENS, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, with_text: bool = False,
) -> DataFrame:
    """One row a piece: id, row, piece, first_token, n_tokens, bucket, bucket_len, batch, slot (place in the batch).

    ``row`` is the same for the pieces of one row of ``docs`` and differs between rows that share an id. ``with_text`` adds
    the piece's text, from its first word to its last.
    """
    cut = pieces_of(docs, id_col, text_col, most)
    held = share(cut if with_text else cut.drop("text")).df
    pieces = held.drop("text").withColumn("digest", F.unhex(F.md5(F.concat_ws(":", F.col("id").cast("string"), F.col("piece").cast("string"), F.col("row").cast("string")))))
    histogram = pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()  # most entries at most
    histogram.sort(key=lambda r: r["n_tokens"])
    lengths = np.array([r["n_tokens"] for r in histogram], dtype=np.int64)
    counts = np.array([r["count"] for r in histogram], dtype=np.int64)
    bounds = best_bounds(lengths, counts, buckets)
    bucket, length = F.lit(None).cast("int"), F.lit(None).cast("long")
    for k, bound in reversed(list(enumerate(bounds))):
        bucket = F.when(F.col("n_tokens") <= bound, F.lit(k)).otherwise(bucket)
        length = F.when(F.col("n_tokens") <= bound, F.lit(bound).cast("long")).otherwise(length)
    some = F.col("n_tokens") > 0
    placed = pieces.withColumn("bucket", F.when(some, bucket)).withColumn("bucket_len", F.when(some, length))
    which = np.searchsorted(np.array(bounds), lengths)
    fullest = max((int(counts[which == k].sum()) for k in range(len(bounds))), default=0)
    ranked = running_total(
        placed.where("bucket IS NOT NULL"), ["bucket"], ["digest", "n_tokens", "row", "piece"], "digest", F.lit(1), fullest, "rank"
    )
    rows = F.greatest(F.lit(1).cast("long"), F.expr(f"{batch_tokens} div bucket_len"))
    done = ranked.withColumn("_rows", rows).select(
        F.col("id").alias(id_col), "row", "piece", "first_token", "n_tokens", "bucket", "bucket_len",
        F.expr("rank div _rows").alias("batch"), (F.col("rank") % F.col("_rows")).alias("slot"),
    )
    none = placed.where("bucket IS NULL").select(
        F.col("id").alias(id_col), "row", "piece", "first_token", "n_tokens", "bucket", "bucket_len",
        F.lit(None).cast("long").alias("batch"), F.lit(None).cast("long").alias("slot"),
    )
    out = done.unionByName(none)
    return out.join(held.select("row", "piece", "text"), ["row", "piece"]).select(*out.columns, "text") if with_text else out
