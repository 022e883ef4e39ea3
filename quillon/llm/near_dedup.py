"""MinHash near-dedup with a multi-index Hamming join.

A document's set is its distinct word shingles. Equal sets are one class, kept by its
smallest identifier. A class has a signature of ``SYMBOLS`` minima of ``16`` bits. Two sets of
similarity s differ in Binomial(SYMBOLS, 1 - s) symbols, and ``DISTANCE`` is the
distance that pairs at the threshold exceed with probability below ``MISS``. The signature
is split into chunks: by pigeonhole, of two signatures within the
distance some chunk differs in at most ``CHUNK_ERRORS`` symbols, and a chunk emits a
key for each choice of symbols left out. Every pair within the distance thus shares a key.

A bucket of classes with one key is represented by its smallest class, the hub. The full sets tell
for each class of the bucket whether it is linked with the hub, and how the two sets differ. Classes
with a common hub meet again: the size of the difference of two sets follows exactly from their
differences from the hub, so every pair that holds a class not linked with the hub is
decided on full sets, without shipping them. A hub with many classes is cut into blocks of ``BLOCK``;
every two blocks meet in a task of their own, and a task gives back links that span its groups, not pairs.

Nulls and repeats: a null, empty or blank text has an empty set and is linked with nothing; rows
with a null identifier are linked with nothing but take the component of an equal set; repeated rows
get equal results. Rows of one identifier with different texts are one node. An empty table gives an empty result.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.components import components
from quillon.llm.kernels import lower_ascii, mix64, prefix_hash, row_slices, shingle_hashes, span_hash, text_buffer, words
from quillon.llm.shared import matched, share

SYMBOLS = 64
CHUNK_ERRORS = 1
MISS = 1e-5
BLOCK = 512
_LINES = 4096


def allowed_distance(percent: int, symbols: int = SYMBOLS, miss: float = MISS) -> int:
    """The smallest distance that a pair at the threshold exceeds with probability below ``miss``."""
    p, total = 1 - percent / 100, 0.0
    for r in range(symbols + 1):
        total += comb(symbols, r) * p**r * (1 - p) ** (symbols - r)
        if 1 - total < miss:
            return r
    return symbols


def chunks_for(distance: int, symbols: int = SYMBOLS, errors: int = CHUNK_ERRORS) -> list[np.ndarray]:
    """Chunks so many that errors + 1 differences in each would exceed the distance."""
    return np.array_split(np.arange(symbols), min(symbols, distance // (errors + 1) + 1))


_MASKS = mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mix64(_MASKS) | np.uint64(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The low 16 bits of ``SYMBOLS`` minima of a set of hashes, a bounded slice of the set at a time."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(hashes), _LINES):
        part = (hashes[k : k + _LINES, None] ^ _MASKS) * _FACTORS
        least = np.minimum(least, part.min(axis=0))
    return mix64(least).astype(np.uint16)


def sets_of(data: np.ndarray, offsets: np.ndarray, n: int):
    """For each row the sorted distinct hashes of its n-word shingles."""
    for a, b in row_slices(offsets):
        own = offsets[a : b + 1] - offsets[a]
        lowered = lower_ascii(data[offsets[a] : offsets[b]])
        starts, ends, first = words(lowered, own)
        hashes = span_hash(prefix_hash(lowered), starts, ends)
        for k in range(b - a):
            yield np.unique(shingle_hashes(hashes[first[k] : first[k + 1]], n))


def signed(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, n, h1, h2, sig): size, two hashes and signature of each document's set."""

    def sign(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            n, h1, h2, sig = [], [], [], []
            for s in sets_of(data, offsets, shingle):
                n.append(len(s))
                h1.append(int(mix64(s).sum(dtype=np.uint64)) if len(s) else 0)
                h2.append(int(np.bitwise_xor.reduce(mix64(s + np.uint64(len(s))))) if len(s) else 0)
                sig.append(signature(s).tobytes() if len(s) else None)
            hashes = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (h1, h2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *hashes, pa.array(sig, pa.binary())], names=["id", "n", "h1", "h2", "sig"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return read.mapInArrow(sign, f"id {kind}, n long, h1 long, h2 long, sig binary")


def _keys(classes: DataFrame, distance: int) -> DataFrame:
    """(key, rep): every chunk of every signature with every choice of a symbol left out."""
    chunks = chunks_for(distance)
    left = [np.delete(c, k) if len(c) > CHUNK_ERRORS else c[:0] for c in chunks for k in range(len(c))]
    salts = mix64(np.arange(1, len(left) + 1, dtype=np.uint64))

    def emit(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            reps = batch.column(0).to_numpy()
            raw, _ = text_buffer(batch.column(1))
            symbols = raw.view(np.uint16).reshape(-1, SYMBOLS).astype(np.uint64)
            for at in range(0, len(reps), _LINES):
                part = symbols[at : at + _LINES]
                keys = np.empty((len(part), len(left)), dtype=np.uint64)
                for j, (columns, salt) in enumerate(zip(left, salts, strict=True)):
                    key = np.full(len(part), salt, dtype=np.uint64)
                    for c in columns:
                        key = mix64(key * np.uint64(0x2545F4914F6CDD1D) + part[:, c] + np.uint64(1))
                    keys[:, j] = key
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(reps[at : at + _LINES], len(left)))], names=["key", "rep"]
                )

    return classes.select("rep", "sig").mapInArrow(emit, "key long, rep long")


def _rooted(stars: DataFrame, classes: DataFrame, distance: int) -> DataFrame:
    """(hub, rep) with hubs replaced by the smallest hub that is near to them, twice over.

    Classes of one bucket keep a common hub, and the many hubs of a family of near copies become few.
    """
    hubs = stars.select(F.col("hub").alias("rep")).distinct()
    signed = classes.select("rep", "sig").join(hubs, "rep", "left_semi")
    between = stars.join(hubs, "rep", "left_semi").join(signed, "rep").join(signed.select(F.col("rep").alias("hub"), F.col("sig").alias("other")), "hub")

    def near(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (text_buffer(batch.column(c))[0].view(np.uint16).reshape(-1, SYMBOLS) for c in (2, 3))
                yield batch.filter(pa.array((x != y).sum(axis=1) <= distance)).select([0, 1])

    close = between.select("hub", "rep", "sig", "other").mapInArrow(near, "hub long, rep long")
    up = share(close.groupBy(F.col("rep").alias("h")).agg(F.min("hub").alias("up"))).df
    second = up.join(up.select(F.col("h").alias("up"), F.col("up").alias("top")), "up", "left")
    roots = share(second.select(F.col("h").alias("hub"), F.coalesce("top", "up").alias("root")))
    moved = matched(stars, roots, "hub", "left").select(F.coalesce("root", "hub").alias("hub"), "rep")
    own = roots.df.select(F.col("root").alias("hub"), F.col("hub").alias("rep"))
    return moved.unionByName(own).where("hub != rep").distinct()


def _stars(stars: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(hub, rep, n, linked, delta): rep's set size, whether it is linked with its hub, and the hashes that only one of the two has."""
    needed = share(stars.select("rep").unionByName(stars.select(F.col("hub").alias("rep"))).distinct())
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    texts = matched(texts, needed, "rep", "left_semi")

    def collect(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            sets = [s.tobytes() for s in sets_of(data, offsets, shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["rep", "hashes"])

    sets = share(texts.mapInArrow(collect, "rep long, hashes binary"))

    def differ(batches):
        for batch in batches:
            linked, n, deltas = [], [], []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint64) for c in (2, 3))
                delta = np.setxor1d(x, y, assume_unique=True)
                linked.append(_linked(len(x), len(y), len(delta), percent))
                n.append(len(x))
                deltas.append(delta.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(linked, pa.bool_()), pa.array(deltas, pa.binary())],
                names=["hub", "rep", "n", "linked", "delta"],
            )

    own = sets.df.withColumnRenamed("hashes", "own")
    hubs = sets.df.select(F.col("rep").alias("hub"), F.col("hashes").alias("other"))
    both = stars.join(own, "rep").join(hubs, "hub").select("hub", "rep", "own", "other")
    table = share(both.mapInArrow(differ, "hub long, rep long, n long, linked boolean, delta binary"))
    sets.drop()
    return table.df


def _linked(n, m, differ, percent: int):
    """100 * intersection >= percent * union, from the sizes of two sets and of their difference."""
    return 100 * (n + m - differ) >= percent * (n + m + differ)


def _spanning(reps, sizes, linked, blocks, i: int, j: int, deltas: list[np.ndarray], percent: int) -> np.ndarray:
    """Links (a, b) that span the groups of the classes of blocks i and j of one hub."""
    lengths = np.array([len(d) for d in deltas])
    flat = np.concatenate(deltas)
    _, code, seen = np.unique(flat, return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(deltas)), lengths)
    often = seen[code] > 1
    member, (columns, code) = member[often], np.unique(code[often], return_inverse=True)
    common = np.zeros((len(deltas), len(deltas)), dtype=np.float32)
    for k in range(0, len(columns), _LINES):
        part = (code >= k) & (code < k + _LINES)
        held = np.zeros((len(deltas), min(_LINES, len(columns) - k)), dtype=np.float32)
        held[member[part], code[part] - k] = 1
        common += held @ held.T
    differ = lengths[:, None] + lengths - 2 * common.astype(np.int64)
    near = _linked(sizes[:, None], sizes, differ, percent) & ~(linked[:, None] & linked)
    near &= ((blocks == i)[:, None] & (blocks == j)) | ((blocks == j)[:, None] & (blocks == i))
    np.fill_diagonal(near, True)
    group = np.arange(len(deltas))
    if linked.any():
        group[linked] = np.flatnonzero(linked)[0]
    while True:
        least = np.where(near, group, len(group)).min(axis=1)
        if linked.any():
            least[linked] = least[linked].min()
        least = np.minimum(least, least[least])
        if (least == group).all():
            break
        group = least
    other = (group != np.arange(len(group))) & ~(linked & linked[group])
    return np.stack([reps[other], reps[group[other]]], axis=1)


def _met(stars: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the classes of a hub, but for those that are linked with it anyway."""
    hubs = stars.groupBy("hub").agg(F.count_if(~F.col("linked")).alias("far"), F.count(F.lit(1)).alias("all")).where("far > 0 AND all > 1")
    hubs = hubs.selectExpr("hub", f"cast(ceil(far / {BLOCK}) AS int) AS far_blocks", f"cast(ceil((all - far) / {BLOCK}) AS int) AS near_blocks")
    spread = F.xxhash64("rep")
    placed = stars.join(hubs, "hub").withColumn(
        "block",
        F.when(F.col("linked"), F.col("far_blocks") + F.pmod(spread, F.greatest("near_blocks", F.lit(1)))).otherwise(F.pmod(spread, F.col("far_blocks"))).cast("int"),
    )
    partners = F.expr("sequence(0, if(linked, far_blocks, far_blocks + near_blocks) - 1)")
    pairs = placed.withColumn("with", F.explode(partners)).select(
        "hub", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "rep", "n", "linked", "block", "delta"
    )

    def meet(batches):
        held: list[pa.RecordBatch] = []

        def settle(rows: pa.RecordBatch):
            keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in range(3)], axis=1)
            edges = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]]))
            reps, sizes, blocks = (rows.column(c).to_numpy() for c in (3, 4, 6))
            linked = rows.column(5).to_numpy(zero_copy_only=False)
            raw, offsets = text_buffer(rows.column(7))
            found = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a > 1:
                    deltas = [np.frombuffer(raw[offsets[k] : offsets[k + 1]].tobytes(), dtype=np.uint64) for k in range(a, b)]
                    found.append(_spanning(reps[a:b], sizes[a:b], linked[a:b], blocks[a:b], keys[a, 1], keys[a, 2], deltas, percent))
            links = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

        def last_key(rows: pa.RecordBatch) -> tuple:
            return tuple(rows.column(c)[-1].as_py() for c in range(3))

        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                end = last_key(part)
                same = np.ones(part.num_rows, dtype=bool)
                for c in range(3):
                    same &= part.column(c).to_numpy() == end[c]
                cut = int(np.argmax(same))  # rows are sorted: the last group may go on
                first = tuple(part.column(c)[0].as_py() for c in range(3))
                if cut or (held and last_key(held[-1]) != first):
                    done, held = [x for x in (*held, part.slice(0, cut)) if x.num_rows], []
                    if done:
                        yield settle(pa.Table.from_batches(done).combine_chunks().to_batches()[0])
                held.append(part.slice(cut))
        if held:
            yield settle(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return pairs.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j").mapInArrow(meet, "a long, b long")


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row a document: id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their shingle
    sets; component_id is the smallest identifier reachable.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"identifiers must be integers, not {kind}")
    distance = allowed_distance(percent)
    rows = share(signed(docs, id_col, text_col, shingle)).df
    classes = share(
        rows.where("n > 0").groupBy("h1", "h2", "n").agg(F.min(F.col("id").cast("long")).alias("rep"), F.first("sig").alias("sig"))
        .where("rep IS NOT NULL")
    ).df

    keys = share(_keys(classes, distance))
    buckets = keys.df.groupBy("key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    buckets = share(buckets).df  # written first, so that the join can split the rows of a large bucket
    stars = share(keys.df.join(buckets, "key").where("rep != hub").select("hub", "rep").distinct()).df
    keys.drop()
    stars = share(_rooted(stars, classes, distance)).df
    stars = _stars(stars, docs, id_col, text_col, shingle, percent)
    links = stars.where("linked").select(F.col("hub").alias("a"), F.col("rep").alias("b")).unionByName(_met(stars, percent))
    groups = share(components(links)).df

    reps = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", F.col("n").alias("m"), F.coalesce("component", "rep").alias("component")
    )
    at = rows.drop("sig").join(reps, ["h1", "h2"], "left").where("m IS NULL OR m = n")
    component = F.coalesce(F.col("component").cast(kind), F.col("id"))
    return at.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, and documents without words."""
    gone = near_dedup(docs, id_col, text_col, shingle, percent).where("NOT kept").select(F.col(id_col).alias("_gone")).distinct()
    return matched(docs, share(gone), F.col(id_col) == F.col("_gone"), "left_anti")


OP1_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id != y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT node, b FROM reach JOIN links ON a = seen),
comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       w.doc_id = coalesce(component_id, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON node = w.doc_id
"""
