"""Nearest neighbours by collision counting over sorted projections.

The base is cut into blocks, the queries into parts; a pair of the two is a unit, and its rows
come to one task as a stream, the base block first. The task indexes the block once and
then passes all queries of the part by it, so memory is bounded by a block and a batch, and a hot vector is spread like any
other. Largest inner product becomes smallest distance: vectors are scaled by the block's largest norm and get one more
coordinate that fills them up to length 1. Each line of ``BASES`` random orthogonal bases keeps its projections
of the block sorted. A query's windows are centred on its own projections; virtual
rehashing widens all windows by ``GROWTH`` until enough of the block collide on ``THRESHOLD`` of the
lines: ``VERIFIED`` of it, but no fewer than ``LEAST_VERIFIED`` for each neighbour asked for. All that do, and no others, are
verified by their inner product in double precision, with no cap: equal vectors collide alike, so ties are whole.

Work is the number of queries times that of rows, as the windows of unstructured vectors hold
most of a block (see the README for figures).

Nulls and repeats: rows with a null id, and vectors that are null, empty, zero or hold null or
non-finite components, take no part; only vectors of the query's length are its candidates.
Rows are told apart even if they share an id: each is a candidate, and each whose id is divisible is a query with
ranks of its own; only the query's own row is left out. Projections are taken of scaled vectors, so any finite magnitude is
searched; an inner product that leaves the range of doubles counts as it comes out, not-a-number last. An
identifier that is no whole number raises TypeError. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from quillon.llm.shared import share

#: A unit holds at most so many bytes of base vectors and projections, and as many queries as base rows.
BLOCK_BYTES = 96 << 20
#: Smaller tables are cut into about this many blocks, none under LEAST_BLOCK rows.
BLOCKS = 16
LEAST_BLOCK = 4096
BASES = 2
THRESHOLD = 0.87
GROWTH = 1.02
VERIFIED = 0.03
LEAST_VERIFIED = 10
NEAREST = 20
_FOLD = 32
_SEED = 20240229


def lines_of(dim: int, bases: int) -> np.ndarray:
    """``bases`` random orthogonal bases side by side, one line a column."""
    rng = np.random.default_rng(_SEED)
    return np.hstack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(bases)])


class Index:
    """The sorted projections of one block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, lines: np.ndarray) -> None:
        self.ids, self.own, self.vectors, self.lines = ids, rows, vectors, lines[:-1]
        n, m = len(ids), lines.shape[1]
        scaled = vectors / np.abs(vectors).max()
        scaled /= np.sqrt((scaled**2).sum(axis=1).max())
        fill = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(axis=1)))
        points = np.hstack([scaled, fill[:, None]]) @ lines
        order = np.argsort(points, axis=0, kind="stable")
        # All lines stand in one array, each shifted by a step wider than any line and any window on it.
        self.shift = 8.0 * np.arange(m)
        self.sorted = (np.take_along_axis(points, order, axis=0) + self.shift).T.ravel()
        self.rows = order.T.astype(np.int32).ravel()
        self.begins = n * np.arange(m)
        self.half, self.step = 0.25 * float(points.std()) + 1e-9, 0

    def found(self, query: np.ndarray, threshold: float, growth: float, enough: int) -> np.ndarray:
        """Rows that collide on ``threshold`` of the lines, in the narrowest windows (of widths that grow by ``growth``) with ``enough`` of them."""
        n, m = len(self.ids), len(self.shift)
        enough, need, ends = min(n, enough), int(np.ceil(threshold * m)), self.begins + n
        unit = query / np.abs(query).max()
        centre = (unit / np.sqrt((unit**2).sum())) @ self.lines + self.shift
        last = int(np.ceil(np.log(4.0 / self.half) / np.log(growth)))

        def colliding(step: int) -> np.ndarray:
            # No projection is further than 2 from a centre, so windows of 4 hold all and end the search.
            half = self.half * growth**step if step < last else 4.0
            lo = np.maximum(np.searchsorted(self.sorted, centre - half, side="left"), self.begins)
            hi = np.minimum(np.searchsorted(self.sorted, centre + half, side="right"), ends)
            if (hi - lo).sum() < need * enough:  # they can't hold enough, however they fall
                return lo[:0]
            # Windows hold most of a line: counting what stands outside is less work.
            outside = [self.rows[a:b] for a, b in zip([*self.begins, *hi], [*lo, *ends], strict=True) if a < b]
            misses = np.bincount(np.concatenate(outside), minlength=n) if outside else np.zeros(n, dtype=np.int64)
            return np.flatnonzero(misses <= m - need)

        # Wider windows hold all that narrower ones do: from the last query's width, leap until the least step that
        # has enough lies between ``short`` (too narrow) and ``step``, then halve.
        step, leap, short = min(self.step, last), 1, -1
        found = colliding(step)
        if len(found) >= enough:
            while step > 0:
                below = max(0, step - leap)
                less = colliding(below)
                if len(less) < enough:
                    short = below
                    break
                found, step, leap = less, below, 2 * leap
        else:
            while step < last and len(found) < enough:
                short, step, leap = step, min(last, step + leap), 2 * leap
                found = colliding(step)
        while step - short > 1:
            middle = (step + short) // 2
            less = colliding(middle)
            if len(less) >= enough:
                found, step = less, middle
            else:
                short = middle
        self.step = step
        return found

    def search(self, query: np.ndarray, row: int, k: int, threshold: float, growth: float, verified: float, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and inner products of the k nearest found, nearest first (ties to the smaller id), and how many were verified."""
        found = self.found(query, threshold, growth, max(least * k, int(np.ceil(verified * len(self.ids)))))
        found = found[self.own[found] != row]
        with np.errstate(over="ignore", invalid="ignore"):
            scores = (self.vectors[found] * query).sum(axis=1)
        best = np.lexsort((self.own[found], self.ids[found], -scores))[:k]
        return found[best], scores[best], len(found)


def nearest(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = NEAREST,
    block_rows: int | None = None, query_rows: int | None = None, bases: int = BASES,
    threshold: float = THRESHOLD, growth: float = GROWTH, verified: float = VERIFIED, least: int = LEAST_VERIFIED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by ``every``."""
    if not isinstance(table.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be a whole number")
    kind = "float" if table.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    usable = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(usable)
    rows = share(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("v"))).df
    asks = F.col("id") % every == 0
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(asks).alias("q"), F.max("dim").alias("dim")).first()
    n, longest = sizes["n"], sizes["dim"] or 1
    if block_rows is None:
        most = max(1, BLOCK_BYTES // (8 * longest + 12 * bases * (longest + 1)))
        block_rows = min(most, max(LEAST_BLOCK, -(-n // BLOCKS)))
        query_rows = query_rows or most
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-sizes["q"] // (query_rows or block_rows)))
    place = F.xxhash64("row")
    base, part = F.pmod(place, F.lit(blocks)).cast("int"), F.pmod(F.floor(place / 65536), F.lit(parts)).cast("int")

    def all_of(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    held = rows.withColumn("base", base).withColumn("part", all_of(parts)).withColumn("asks", F.lit(False))
    asked = rows.where(asks).withColumn("part", part).withColumn("base", all_of(blocks)).withColumn("asks", F.lit(True))
    columns = ["dim", "base", "part", "asks", "row", "id", "v"]
    units = held.select(*columns).unionByName(asked.select(*columns)).repartition(blocks * parts, "dim", "base", "part").sortWithinPartitions(*columns[:5])

    def search(batches):
        unit, pieces, index = None, [], None
        for batch in batches:
            dim, where, which, query = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            new = (dim[1:] != dim[:-1]) | (where[1:] != where[:-1]) | (which[1:] != which[:-1]) | (query[1:] != query[:-1])
            edges = [0, *(np.flatnonzero(new) + 1), len(dim)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if (dim[a], where[a], which[a]) != unit:
                    unit, pieces, index = (dim[a], where[a], which[a]), [], None
                own = batch.column(4).slice(a, b - a).to_numpy()
                ids = batch.column(5).slice(a, b - a).to_numpy()
                flat = batch.column(6).slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
                vectors = flat.astype(np.float64).reshape(b - a, int(dim[a]))
                if not query[a]:
                    pieces.append((ids, own, vectors))
                    continue
                if index is None:
                    if not pieces:
                        continue  # no vector of this length in the block
                    index = Index(*(np.concatenate(x) for x in zip(*pieces, strict=True)), lines_of(int(dim[a]) + 1, bases))
                    pieces = []
                hits = [index.search(v, r, k, threshold, growth, verified, least) for v, r in zip(vectors, own, strict=True)]
                count = [len(at) for at, _, _ in hits]
                at = np.concatenate([h[0] for h in hits])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own, count)), pa.array(np.repeat(ids, count)), pa.array(np.full(len(at), where[a], dtype=np.int32)),
                        pa.array(index.ids[at]), pa.array(index.own[at]), pa.array(np.concatenate([h[1] for h in hits])),
                    ],
                    names=["query", "query_id", "base", "vec_id", "row", "score"],
                )

    found = units.mapInArrow(search, "query long, query_id long, base int, vec_id long, row long, score double")
    found = found.select("query", "query_id", "base", F.struct((-F.col("score")).alias("far"), "vec_id", "row", "score").alias("hit"))

    def best(hits: DataFrame, keys: list[str]) -> DataFrame:
        listed = hits.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list("hit")), 1, k).alias("best"))
        return listed.select(*keys, F.posexplode("best").alias("at", "hit"))

    while blocks > _FOLD:  # a query's finds are merged a bounded number of blocks at a time
        found = best(found.withColumn("base", F.expr(f"base div {_FOLD}").cast("int")), ["query", "query_id", "base"]).drop("at")
        blocks = -(-blocks // _FOLD)
    return best(found, ["query", "query_id"]).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
