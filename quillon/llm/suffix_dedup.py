"""Removal of long byte strings that repeat, by ranks of sampled positions at three growing lengths.

This is no prefix doubling over all positions (see the README for why); it shares its idea. Prefix doubling names a position by the pair of its own rank and the rank of the position one
offset further on, and drops positions whose rank is unique. Here a rank is a 64-bit
fingerprint, so a pair is named without a global sort, and positions are sampled: of the
``ANCHOR``-byte strings in every ``LENGTH``-byte window the one with the smallest
fingerprint is the window's anchor. Equal windows have equal anchors at equal offsets, so
windows meet where their anchors do. Consecutive windows with one anchor are a run.

1. rank at ``ANCHOR`` bytes: runs whose anchor is unique are dropped;
2. pair of that rank and the rank of the run's whole string: equal pairs mean that every window of the
   runs repeats;
3. ranks at ``LENGTH`` bytes, for the windows of runs that are still open, against one run of each
   different string with the same anchor.

A class of anchors is resolved in one task up to ``MOST_IN_TASK`` different strings; beyond that its
windows are counted by Spark one by one. Whole texts are read, a slice of bounded size at a time.

Strings count as equal if two 64-bit fingerprints are, of their anchor and of the string. Rows are told apart by a number of
their own, written beside the text first.

Nulls and repeats: a null or empty text has no bytes and nothing is removed; a row that stands twice
repeats itself; rows may share identifiers or have none. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.kernels import prefix_hash, row_slices, span_hash, text_buffer
from quillon.llm.shared import share

LENGTH = 200
ANCHOR = 56
MOST_IN_TASK = 4096
_CHUNK = 1 << 19
_PLACE = np.uint64((1 << 22) - 1)
_U = np.uint64


def _runs(data: np.ndarray, own: np.ndarray, length: int, anchor: int):
    """Row, first window, windows, anchor rank and whole rank of the runs of a slice."""
    n, width = len(data), length - anchor + 1
    if n < length:
        return None
    sums = prefix_hash(data)
    places = np.arange(n - anchor + 1)
    ranks = span_hash(sums, places, places + anchor)
    keys = (ranks & ~_PLACE) | places.astype(_U)  # of equal ranks the first place counts
    blocks = np.concatenate([keys, np.full(-len(keys) % width, np.iinfo(np.uint64).max, dtype=_U)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    m = n - length + 1
    at = (np.minimum(ahead[:m], behind[width - 1 : width - 1 + m]) & _PLACE).astype(np.int64)
    inside = np.zeros(m + 1, dtype=np.int32)
    full = np.flatnonzero(np.diff(own) >= length)
    np.add.at(inside, own[full], 1)
    np.add.at(inside, np.minimum(own[full + 1] - length + 1, m), -1)
    inside = np.cumsum(inside[:m]) > 0
    first = np.ones(m, dtype=bool)
    first[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])
    first[own[full]] = True
    lo = np.flatnonzero(first)
    hi = np.append(lo[1:], m)
    lo, hi = lo[inside[lo]], hi[inside[lo]]
    row = np.searchsorted(own, lo, side="right") - 1
    return row, lo - own[row], hi - lo, ranks[at[lo]], span_hash(sums, lo, hi - 1 + length)


def _slices(data: np.ndarray, offsets: np.ndarray, length: int):
    """(first row, bytes, row offsets, shift): slices of rows; a long row comes in chunks that overlap by a window."""
    for a, b in row_slices(offsets, _CHUNK):
        raw = data[offsets[a] : offsets[b]]
        if len(raw) <= 2 * _CHUNK:
            yield a, raw, offsets[a : b + 1] - offsets[a], 0
        else:
            for at in range(0, len(raw) - length + 1, _CHUNK):
                part = raw[at : at + _CHUNK + length - 1]
                yield a, part, np.array([0, len(part)]), at


def runs_of(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """(id, lo, n, a, w): the runs of every text, with the ranks of anchor and whole string."""

    def find(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, raw, own, shift in _slices(data, offsets, length):
                found = _runs(raw, own, length, anchor)
                if found is None or not len(found[0]):
                    continue
                row, lo, n, ranks, whole = found
                row = row + a
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row)), pa.array(lo + shift), pa.array(n.astype(np.int32)),
                        pa.array(ranks.view(np.int64)), pa.array(whole.view(np.int64)),
                    ],
                    names=["id", "lo", "n", "a", "w"],
                )

    return docs.mapInArrow(find, "id long, lo long, n int, a long, w long")


def _strings(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The strings of the wanted runs: (a, id, lo, n, alone, large, s)."""
    listed = wanted.groupBy("id").agg(F.collect_list(F.struct("lo", "n", "a", "alone", "large")).alias("runs"))
    joined = docs.join(listed, "id").select("id", "text", "runs")

    def cut(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            lists = batch.column(2)
            for i in range(0, batch.num_rows, 256):
                flat = lists.slice(i, 256).flatten()
                row = np.repeat(np.arange(i, min(i + 256, batch.num_rows)), np.diff(lists.slice(i, 256).offsets.to_numpy()))
                field = {name: flat.field(k) for k, name in enumerate(("lo", "n", "a", "alone", "large"))}
                starts = offsets[row] + field["lo"].to_numpy()
                ends = starts + field["n"].to_numpy() - 1 + length
                strings = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [field["a"], batch.column(0).take(pa.array(row)), *[field[c] for c in ("lo", "n", "alone", "large")], pa.array(strings, pa.binary())],
                    names=["a", "id", "lo", "n", "alone", "large", "s"],
                )

    return joined.mapInArrow(cut, "a long, id long, lo long, n int, alone boolean, large boolean, s binary")


def _windows(batch: pa.RecordBatch, length: int):
    """Rank and row of every window of the strings of a batch, and its place in the text."""
    data, offsets = text_buffer(batch.column(batch.schema.get_field_index("s")))
    n = batch.column(batch.schema.get_field_index("n")).to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[row] + inner
    return span_hash(prefix_hash(data), at, at + length), row, batch.column(batch.schema.get_field_index("lo")).to_numpy()[row] + inner


def _resolved(strings: DataFrame, length: int) -> DataFrame:
    """Repeated stretches (id, lo, n) of the lone runs of classes that fit a task."""

    def settle(batch: pa.RecordBatch) -> pa.RecordBatch:
        ranks, row, place = _windows(batch, length)
        _, back, counts = np.unique(ranks, return_inverse=True, return_counts=True)
        hit = (counts[back] > 1) & batch.column(4).to_numpy(zero_copy_only=False)[row]
        begins, closes = hit.copy(), hit.copy()
        begins[1:] &= ~(hit[:-1] & (row[1:] == row[:-1]))
        closes[:-1] &= ~(hit[1:] & (row[1:] == row[:-1]))
        s, e = np.flatnonzero(begins), np.flatnonzero(closes)
        at = pa.array(row[s])
        return pa.RecordBatch.from_arrays(
            [batch.column(1).take(at), pa.array(place[s]), pa.array((e - s + 1).astype(np.int32))],
            names=["id", "lo", "n"],
        )

    def resolve(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                a = part.column(0).to_numpy()
                cut = int(np.searchsorted(a, a[-1], side="left"))  # the last class may go on
                if cut or (held and held[-1].column(0)[-1].as_py() != a[0]):
                    done, held = [*held, part.slice(0, cut)], []
                    yield settle(pa.Table.from_batches(done).combine_chunks().to_batches()[0])
                held.append(part.slice(cut))
        if held:
            yield settle(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    sorted_by_class = strings.repartition("a").sortWithinPartitions("a")
    return sorted_by_class.mapInArrow(resolve, "id long, lo long, n int")


def _counted(strings: DataFrame, length: int) -> DataFrame:
    """The same for larger classes: Spark counts their windows one by one."""

    def emit(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                ranks, row, place = _windows(part, length)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(ranks.view(np.int64)), part.column(1).take(at), pa.array(place), part.column(4).take(at)],
                    names=["a", "r", "id", "lo", "alone"],
                )

    windows = share(strings.mapInArrow(emit, "a long, r long, id long, lo long, alone boolean")).df
    twice = windows.groupBy("a", "r").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("a", "r")
    return windows.where("alone").join(twice, ["a", "r"], "left_semi").select("id", "lo", F.lit(1).alias("n"))


def repeated_stretches(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(id, lo, n): n windows from byte lo of a text that also start elsewhere, for docs (id, text) with a number of its own in each row."""
    runs = share(runs_of(docs, length, anchor))
    # Written first, so that a join can split the runs of a frequent anchor.
    twice = share(runs.df.groupBy("a").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("a")).df
    kept = share(runs.df.join(twice, "a", "left_semi"))
    runs.drop()
    groups = share(kept.df.groupBy("a", "w").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("id", "lo", "n")).alias("first"))).df
    classes = share(groups.groupBy("a").agg(F.count(F.lit(1)).alias("strings"), F.count_if(F.col("c") == 1).alias("lone")).where("lone > 0")).df
    opened = groups.join(classes, "a").select(
        "a", "first.*", (F.col("c") == 1).alias("alone"), (F.col("strings") > MOST_IN_TASK).alias("large")
    )
    strings = share(_strings(docs, share(opened).df, length)).df
    several = share(groups.where("c > 1").select("a", "w")).df
    whole = kept.df.join(several, ["a", "w"], "left_semi").select("id", "lo", "n")
    out = whole.unionByName(_resolved(strings.where("NOT large"), length))
    large = strings.where("large")
    return out if large.isEmpty() else out.unionByName(_counted(large, length))


def spans(lo: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs [start, end) of windows that start at lo..lo + n - 1."""
    order = np.argsort(lo, kind="stable")
    starts, ends = lo[order], np.maximum.accumulate((lo + n - 1 + length)[order])
    first = np.ones(len(starts), dtype=bool)
    first[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(first)[1:], len(starts)) - 1
    return starts[first], ends[last]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """One row a document: id, n_bytes, spans (removed runs: start, end) and kept, the remaining bytes' sha256."""
    held = share(docs.select(F.monotonically_increasing_id().alias("id"), F.col(id_col).alias("own"), F.col(text_col).alias("text"))).df
    found = share(repeated_stretches(held.select("id", "text"), length, anchor)).df
    listed = found.groupBy("id").agg(F.collect_list(F.struct("lo", "n")).alias("found"))
    joined = held.join(listed, "id", "left").select("own", "text", "found")
    kind = held.schema["own"].dataType.simpleString()
    runs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            sizes, removed, digests = np.diff(offsets), [], []
            for i in range(batch.num_rows):
                text, own = data[offsets[i] : offsets[i + 1]], []
                if batch.column(2)[i].is_valid:
                    flat = batch.column(2)[i].values
                    lo, n = flat.field(0).to_numpy(), flat.field(1).to_numpy().astype(np.int64)
                    if len(lo):
                        starts, ends = spans(lo, n, length)
                        own = [{"start": int(s), "end": int(e)} for s, e in zip(starts, ends, strict=True)]
                        edges = np.concatenate([[0], np.stack([starts, ends], axis=1).ravel(), [len(text)]])
                        text = np.concatenate([text[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True)])
                removed.append(own)
                digests.append(hashlib.sha256(text.tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(removed, runs), pa.array(digests)], names=["id", "n_bytes", "spans", "kept_sha256"]
            )

    out = joined.mapInArrow(remove, f"id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept_sha256 string")
    return out.withColumnRenamed("id", id_col)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digest of ``without_repeats``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return without_repeats(docs, id_col, text_col).select(
        id_col, "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


OP6_SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM t WHERE length(h) >= 400),
m AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS r FROM w),
f AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY r) AS c FROM m) WHERE c > 1),
g AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 1 ELSE 0 END AS new FROM f),
s AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM g),
e AS (SELECT doc_id, span, min(p) AS a, max(p) + 200 AS b FROM s GROUP BY ALL),
k AS (SELECT e.doc_id, e.a, e.b, substr(h, 2 * coalesce(lag(e.b) OVER x, 0) + 1, 2 * (e.a - coalesce(lag(e.b) OVER x, 0))) AS before
      FROM e JOIN t ON t.doc_id = e.doc_id WINDOW x AS (PARTITION BY e.doc_id ORDER BY e.a)),
j AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_b, string_agg(before, '' ORDER BY a) AS head FROM k GROUP BY doc_id)
SELECT t.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last_b, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN j ON j.doc_id = t.doc_id
"""
