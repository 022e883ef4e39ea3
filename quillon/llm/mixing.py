"""Mixing sources to target weights by a low-discrepancy schedule.

A source's documents stand on a line in a fixed shuffled order (md5 of the
identifier) and the line is cut into blocks of ``BLOCK_WORDS`` words. Slot i of the
mix takes the golden-ratio point frac(i * phi), in 64-bit integers; the cumulative
target weights map the point to a source, and the slot's rank among the source's slots tells the
block that it takes, by a permutation of the source's blocks within a pass. Past the line's end a source starts its second pass. A
source's slots end at its target, so its words meet it to the word, and
any stretch of the schedule is near the target shares.

Sources are ranked, weighed and given their targets and stretches of the schedule by running totals in Spark, however many
there are; the driver sees sums over all of them.

Nulls and repeats: a null or empty text has size 0 and is never taken; null
sources form one source, ordered last, and other types go by their text; null identifiers shuffle as empty
ones; equal identifiers are ordered by size; repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.llm.kernels import count_words, prefix_hash, row_slices, span_hash, text_buffer, words
from quillon.llm.shared import matched, running_total, share
from quillon.session import Step

WEIGHTS = (5.0, 2.0, 1.0)
SHARE_OF_ALL = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 1024
_GOLDEN = 0x9E3779B97F4A7C15
_CHUNK = 8192
_CIRCLE = 1 << 62
_RUN = 1 << 16


def measured(docs: DataFrame, id_col: str, source_col: str, text_col: str, seq: Column | None = None) -> Step:
    """(seq, id, source, size, print, digest) of each document, as a table in the shared folder; ``seq`` tells the rows apart."""

    def measure(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            prints = np.zeros(len(offsets) - 1, dtype=np.int64)
            for a, b in row_slices(offsets):
                own = offsets[a : b + 1] - offsets[a]
                sums = prefix_hash(data[offsets[a] : offsets[b]])
                prints[a:b] = span_hash(sums, own[:-1], own[1:]).view(np.int64)
            sizes = pa.array(count_words(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, pa.array(prints), batch.column(3)], names=["id", "source", "size", "print", "seq"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"), (F.monotonically_increasing_id() if seq is None else seq).alias("seq"))
    return share(
        read.mapInArrow(measure, f"id {kind}, source string, size long, print long, seq long")
        .withColumn("digest", F.unhex(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))))
    )


def _before(rows: DataFrame, order: list[Column], **amounts: Column) -> DataFrame:
    """Adds ``place``, which grows in ``order``, and under each name the sum of its amount over the rows before."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({f"_{n}": a for n, a in amounts.items()})
    placed = share(placed.withColumn("place", F.monotonically_increasing_id())).df.withColumn("_part", F.shiftright("place", 33))
    sums = placed.groupBy("_part").agg(*[F.sum(f"_{n}").alias(f"_sum_{n}") for n in amounts])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    sums = sums.select("_part", *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_from_{n}") for n in amounts])
    inside = Window.partitionBy("_part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumns({n: F.coalesce(F.sum(f"_{n}").over(inside), F.lit(0)) for n in amounts}).join(F.broadcast(sums), "_part")
    return out.withColumns({n: F.col(n) + F.col(f"_from_{n}") for n in amounts}).drop("_part", *[f"_{n}" for n in amounts], *[f"_from_{n}" for n in amounts])


def _steps(batches):
    """Adds to each source multipliers that permute its blocks of each pass: about 0.618 of the count, and coprime to it."""
    for batch in batches:
        out = []
        for name in ("first_blocks", "more_blocks"):
            found = []
            for n in batch.column(batch.schema.get_field_index(name)).to_pylist():
                step = min(int(0.618 * n), 1 << 28) | 1
                while math.gcd(step, max(n, 1)) != 1:
                    step += 2
                found.append(step)
            out.append(pa.array(found, pa.int64()))
        yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, "first_step", "more_step"])


def plan_sources(rows: DataFrame, weights=WEIGHTS, share_of_all: float = SHARE_OF_ALL, most: int = MOST_PASSES, block: int = BLOCK_WORDS) -> Step:
    """Each source's number s (in code point order, null last), name, rows, source_size, target, words and quota of blocks.

    Targets are shares of ``share_of_all`` of all words by weight, none above ``most`` times its source's size; the excess is
    shared again by weight. The level at which a source fills up is most * size / weight: sources fill in
    that order, and the rest share what is left. ``lo`` and ``hi`` are its stretch of the circle of ``_CIRCLE`` points.
    """
    by_name = [F.col("name").isNull(), F.col("name")]
    found = rows.groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    numbered = _before(found, by_name, s=F.lit(1)).drop("place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("s") % len(weights) + 1).cast("int"))
    numbered = numbered.withColumn("weight", weight).withColumn("full", most * F.col("source_size"))
    levels = share(_before(numbered, [F.col("full") / F.col("weight"), *by_name], filled=F.col("full"), used=F.col("weight"))).df
    sums = levels.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    left = F.lit(share_of_all * float(sums["size"] or 0)) - F.col("filled")
    open_weight = F.lit(float(sums["weight"] or 0)) - F.col("used")
    short = levels.where(F.col("full") * open_weight > left * F.col("weight")).agg(F.min(F.struct("place", (left / open_weight).alias("level"))).alias("m")).first()["m"]
    target = F.col("full").cast("double")
    if short is not None:
        target = F.when(F.col("place") >= short["place"], F.lit(short["level"]) * F.col("weight")).otherwise(target)
    sized = levels.withColumn("target", target).withColumn("words", F.floor("target"))
    sized = sized.withColumn("quota", F.expr(f"(words + {block - 1}) div {block}")).select("s", "name", "rows", "source_size", "target", "words", "quota")
    circled = _before(sized, [F.col("s")], begin=F.col("quota")).drop("place")
    total = max(1, circled.agg(F.sum("quota")).first()[0] or 0)
    point = lambda n: F.when(n == total, F.lit(_CIRCLE)).otherwise(F.floor(n / float(total) * float(_CIRCLE))).cast("long")
    circled = circled.withColumn("lo", point(F.col("begin"))).withColumn("hi", point(F.col("begin") + F.col("quota"))).drop("begin")
    circled = circled.withColumn("first_blocks", F.least("quota", F.expr(f"source_size div {block}"))).withColumn("more_blocks", F.col("quota") - F.col("first_blocks"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in circled.schema.fields)
    return share(circled.mapInArrow(_steps, schema + ", first_step long, more_step long"))


def schedule(sources: Step) -> DataFrame:
    """(slot, s, block): which source each slot of the mix takes from, and which of its blocks."""
    spark = sources.spark
    plan = sources.df.where("quota > 0")
    total, n = (x or 0 for x in sources.df.agg(F.sum("quota"), F.count(F.lit(1))).first())
    width = -(-_CIRCLE // max(1, total))  # about one slot's point falls into each stretch of this width

    def draw(batches):
        for batch in batches:
            points = (batch.column(0).to_numpy().astype(np.uint64) * np.uint64(_GOLDEN)) >> np.uint64(2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(points.astype(np.int64))], names=["slot", "point"])

    points = spark.range(total).select(F.col("id").alias("slot")).mapInArrow(draw, "slot long, point long").withColumn("cell", F.expr(f"point div {width}L"))
    cells = plan.select("s", "lo", "hi", F.expr(f"lo div {width}L").alias("a"), F.expr(f"(hi - 1) div {width}L").alias("b"))
    runs = cells.select("s", "lo", "hi", "b", F.explode(F.sequence("a", "b", F.lit(_RUN).cast("long"))).alias("a"))
    cells = runs.select("s", "lo", "hi", F.explode(F.sequence("a", F.least("b", F.col("a") + _RUN - 1))).alias("cell"))
    drawn = points.join(cells, "cell").where("point >= lo AND point < hi").select("slot", "s", F.expr(f"slot div {_CHUNK}").alias("chunk"))
    drawn = share(drawn).df
    counts = drawn.groupBy("s", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("s", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("s", "chunk").orderBy("slot")
    ranked = drawn.withColumn("k", F.row_number().over(inside)).join(starts, ["s", "chunk"]).select("slot", "s", (F.col("start") + F.col("k") - 1).alias("rank"))
    # Points are off a share by a few slots at most; what a source still lacks comes last.
    short = (
        plan.select("s", "quota").join(counts.groupBy("s").agg(F.sum("n").alias("got")), "s", "left")
        .select("s", "quota", F.coalesce("got", F.lit(0)).alias("got"))
        .where("got < quota")
        .select("s", F.explode(F.sequence(F.col("got"), F.col("quota") - 1)).alias("rank"))
        .select((F.lit(total) + F.col("rank") * n + F.col("s")).alias("slot"), "s", "rank")
    )
    own = matched(ranked.unionByName(short).withColumnRenamed("s", "_s"), sources, F.col("_s") == F.col("s"), "inner").where("rank < quota")
    first, later = F.col("rank") < F.col("first_blocks"), F.col("rank") - F.col("first_blocks")
    # Both branches may be worked out for every row, so neither divides by zero.
    own_pass = lambda rank, kind: rank * F.col(f"{kind}_step") % F.greatest(F.col(f"{kind}_blocks"), F.lit(1))
    block = F.when(first, own_pass(F.col("rank"), "first")).otherwise(F.col("first_blocks") + own_pass(later, "more"))
    return own.select("slot", "s", block.alias("block"))


def _same_source() -> Column:
    return F.col("source").eqNullSafe(F.col("name"))


def mix(rows: DataFrame, sources: Step, block: int = BLOCK_WORDS) -> DataFrame:
    """The mix: (slot, seq, s, pass, first_word, n_words), one row for each stretch of a document in a slot."""
    largest = sources.df.agg(F.max("rows")).first()[0] or 0
    placed = running_total(
        rows.where("size > 0").select("seq", "source", "size", "digest", "print"),
        ["source"], ["digest", "size", "print", "seq"], "digest", F.col("size"), largest, "start",
    )
    placed = matched(placed, sources, _same_source(), "inner").select("seq", "s", "size", "start", "source_size", "words")
    passes = F.explode(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1)))
    at = placed.withColumn("pass", passes).withColumn("at", F.col("start") + F.col("pass") * F.col("source_size"))
    at = at.where("at < words").withColumn("to", F.least(F.col("at") + F.col("size"), F.col("words")))
    pieces = at.withColumn("block", F.explode(F.expr(f"sequence(at div {block}, (to - 1) div {block})")))
    pieces = pieces.select(
        "seq", "s", "pass", "block",
        (F.greatest(F.col("at"), F.col("block") * block) - F.col("at")).alias("first_word"),
        (F.least(F.col("to"), (F.col("block") + 1) * block) - F.greatest(F.col("at"), F.col("block") * block)).alias("n_words"),
    )
    return pieces.join(schedule(sources), ["s", "block"]).select("slot", "seq", "s", "pass", "first_word", "n_words")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block: int = BLOCK_WORDS) -> DataFrame:
    """One row a document: id, size, source_size, target, taken (the words the mix takes), first_slot and n_slots of its stretches."""
    rows = measured(docs, id_col, source_col, text_col).df
    sources = plan_sources(rows, block=block)
    taken = mix(rows, sources, block).groupBy("seq").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_slots"))
    return (
        matched(rows, sources, _same_source(), "inner").join(taken, "seq", "left")
        .select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot", F.coalesce("n_slots", F.lit(0)).alias("n_slots"))
    )


def mixed_corpus(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix: the columns of ``docs``, then mix_pass and mix_slot, a row for each pass over a document.

    mix_slot is the first slot that holds words of the row, and rows come in its order. The document at which a source's target ends
    gives its first words only; ``n_chars``, if there, then follows the text.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    held = share(docs.withColumn(row, F.monotonically_increasing_id())).df
    rows = measured(held, id_col, source_col, text_col, F.col(row)).df
    taken = mix(rows, plan_sources(rows, block=block), block).groupBy("seq", "pass").agg(F.sum("n_words").alias("n"), F.min("slot").alias("slot"))
    taken = taken.join(rows.select("seq", "size"), "seq")
    names = ["mix_pass", "mix_slot"]
    passes = taken.select(F.col("seq").alias(row), F.col("pass").cast("int").alias(names[0]), F.col("slot").alias(names[1]), F.when(F.col("n") < F.col("size"), F.col("n")).alias("_words"))
    joined = held.join(passes, row)
    whole = joined.where("_words IS NULL").drop("_words", row)
    # The row at which a source's target ends, one a source, is cut.
    part = joined.where("_words IS NOT NULL").select("_words", *whole.columns)
    at_text, at_chars = whole.columns.index(text_col), whole.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(batches):
        for batch in batches:
            columns, texts = list(batch.columns[1:]), batch.column(at_text + 1)
            data, offsets = text_buffer(texts)
            short = []
            for k, n in enumerate(batch.column(0).to_pylist()):
                own = data[offsets[k] : offsets[k + 1]]
                _, ends, _ = words(own, np.array([0, len(own)]))
                short.append(own[: ends[n - 1]].tobytes().decode())
            columns[at_text] = pa.array(short, pa.string()).cast(texts.type)
            if at_chars is not None:
                columns[at_chars] = pa.array([len(t) for t in short], pa.int64()).cast(columns[at_chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[1:])

    out = whole.unionByName(part.mapInArrow(cut, whole.schema))
    return out.repartitionByRange(names[1]).sortWithinPartitions(*names[::-1], F.col(id_col))


OP3_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()
         - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_words,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight
  FROM s),
f AS (SELECT *, CASE WHEN 2 * source_size * left_weight > left_words * w THEN left_words / left_weight END AS level FROM o),
l AS (SELECT arg_min(level, 2 * source_size / w) FILTER (level IS NOT NULL) AS level FROM f),
t AS (SELECT f.source, f.source_size, CASE WHEN f.level IS NULL THEN 2.0::DOUBLE * f.source_size ELSE l.level * f.w END AS target FROM f, l),
p AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS q,
         (sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(pos + size, q) - pos) + greatest(0, least(pos + source_size + size, q) - pos - source_size))::BIGINT AS taken
FROM p
"""
