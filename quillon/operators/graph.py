"""Operators on triples: populations, slices, lists and the class hierarchy.

All take the ``triples`` DataFrame (see quillon.schemas) of any number of ontologies and
key their results by ``onto_id``. Only the predicates that an operator needs are
read: with triples partitioned by ``p`` the filters prune partitions.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon import vocab as V
from quillon.session import materialise

KEY = ["onto_id", "s"]


def graph(triples: DataFrame) -> DataFrame:
    """An RDF graph is a set."""
    return triples.dropDuplicates()


def pairs(triples: DataFrame, *predicates: str) -> DataFrame:
    """The slice of one or several predicates."""
    return triples.where(F.col("p") == predicates[0]) if len(predicates) == 1 else triples.where(F.col("p").isin(*predicates))


def of_type(triples: DataFrame, *types: str) -> DataFrame:
    """(onto_id, s, s_kind) of the subjects of any of the types."""
    typed = pairs(triples, V.TYPE)
    return typed.where(F.col("o").isin(*types) & (F.col("o_kind") != "literal")).select("onto_id", "s", "s_kind").distinct()


def classes(triples: DataFrame) -> DataFrame:
    """(onto_id, iri): IRIs typed as a class or concept, and both ends of subClassOf."""
    typed = of_type(triples, *V.CLASS_TYPES).where("s_kind = 'iri'").select("onto_id", F.col("s").alias("iri"))
    sub = pairs(triples, V.SUBCLASS)
    below = sub.where("s_kind = 'iri'").select("onto_id", F.col("s").alias("iri"))
    above = sub.where("o_kind = 'iri'").select("onto_id", F.col("o").alias("iri"))
    return typed.unionByName(below).unionByName(above).distinct()


def named_classes(class_set: DataFrame) -> DataFrame:
    return class_set.where(~F.col("iri").isin(V.THING, V.NOTHING))


def individuals(triples: DataFrame, class_set: DataFrame | None = None) -> DataFrame:
    """(onto_id, iri, node_kind): subjects typed with a class that are not classes; blank nodes too."""
    class_set = classes(triples) if class_set is None else class_set
    typed = pairs(triples, V.TYPE).where("o_kind != 'literal'")
    with_class = typed.join(class_set.withColumnRenamed("iri", "o"), ["onto_id", "o"], "left_semi")
    subjects = with_class.select("onto_id", F.col("s").alias("iri"), F.col("s_kind").alias("node_kind")).distinct()
    return subjects.join(class_set, ["onto_id", "iri"], "left_anti")


def entities(triples: DataFrame, class_set: DataFrame | None = None) -> DataFrame:
    """(onto_id, iri, node_kind, kind): classes and individuals, which are disjoint."""
    class_set = classes(triples) if class_set is None else class_set
    named = class_set.select("onto_id", "iri", F.lit("iri").alias("node_kind"), F.lit("class").alias("kind"))
    return named.unionByName(individuals(triples, class_set).withColumn("kind", F.lit("individual")))


def annotation_properties(triples: DataFrame) -> DataFrame:
    return of_type(triples, V.ANNOTATION).select("onto_id", F.col("s").alias("p"))


def object_properties(triples: DataFrame) -> DataFrame:
    """(onto_id, p): declared object properties, and predicates with a node object that are neither structural nor
    annotation; without the annotation properties."""
    linking = triples.where(~F.col("p").isin(*V.STRUCTURAL, *V.CONNECTION_ANNOTATIONS) & (F.col("o_kind") != "literal"))
    linking = linking.select("onto_id", "p").distinct()
    declared = of_type(triples, V.OBJECT_PROPERTY).select("onto_id", F.col("s").alias("p"))
    either = linking.unionByName(declared).distinct().where(~F.col("p").isin(*V.CONNECTION_ANNOTATIONS))
    return either.join(annotation_properties(triples), ["onto_id", "p"], "left_anti")


def first_labels(triples: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(onto_id, s, label, source): the best label of each labelled subject; ties go to the smallest value."""
    order = F.when(F.col("p") == V.PREF_LABEL, 0).otherwise(1)
    labels = pairs(triples, *V.LABEL_PROPERTIES)
    if wanted is not None:
        labels = labels.join(wanted.select("onto_id", F.col("iri").alias("s")), KEY, "left_semi")
    best = labels.groupBy(*KEY).agg(F.min(F.struct(order.alias("prio"), "o")).alias("m"))
    return best.select(*KEY, F.col("m.o").alias("label"), F.when(F.col("m.prio") == 0, "skos:prefLabel").otherwise("rdfs:label").alias("source"))


def list_items(triples: DataFrame, heads: DataFrame) -> DataFrame:
    """(onto_id, head, position, item, item_kind) of RDF lists that begin at ``heads`` (onto_id, head).

    A list ends at nil, at a cell without first or rest, or at a cell already seen. A cell's first and rest are its
    smallest values. Round k knows the cells up to 2^k steps from a head and joins them with the cell 2^k steps on, so a
    list of n cells takes log2(n) rounds; a round that finds no new cell of any list, cyclic ones too, is the last.
    """
    def smallest(predicate: str, name: str) -> DataFrame:
        return pairs(triples, predicate).groupBy(*KEY).agg(F.min(F.struct("o", "o_kind")).alias(name))

    cells = smallest(V.FIRST, "f").join(smallest(V.REST, "r"), KEY, "left").where(F.col("s") != V.NIL).select(
        "onto_id", F.col("s").alias("cell"), F.col("f.o").alias("item"), F.col("f.o_kind").alias("item_kind"), F.col("r.o").alias("next")
    )
    cells = materialise(cells)
    known = cells.select("onto_id", F.col("cell").alias("next"))
    jump = cells.where("next IS NOT NULL").join(known, ["onto_id", "next"], "left_semi").select("onto_id", "cell", "next")
    begun = heads.select("onto_id", "head", F.col("head").alias("cell")).distinct().join(cells.select("onto_id", "cell"), ["onto_id", "cell"], "left_semi")
    reach, found, step = begun.withColumn("position", F.lit(0)), -1, 1
    while True:
        reach = materialise(reach)
        n = reach.count()
        if n == found:
            return reach.join(cells, ["onto_id", "cell"]).select("onto_id", "head", "position", "item", "item_kind")
        if found >= 0:
            further = jump.select("onto_id", F.col("cell").alias("next"), F.col("next").alias("last"))
            jump = materialise(jump.join(further, ["onto_id", "next"]).select("onto_id", "cell", F.col("last").alias("next")))
        found = n
        onward = reach.join(jump, ["onto_id", "cell"]).select("onto_id", F.col("next").alias("cell"), "head", (F.col("position") + step).alias("position"))
        step *= 2
        reach = reach.select(*onward.columns).unionByName(onward).groupBy("onto_id", "cell", "head").agg(F.min("position").alias("position"))


def fillers(triples: DataFrame) -> DataFrame:
    return pairs(triples, *V.FILLERS).select("onto_id", F.col("s").alias("node"), F.col("o").alias("parent"), F.col("o_kind").alias("parent_kind")).distinct()


def expression_parents(triples: DataFrame) -> DataFrame:
    """(onto_id, node, parent): what a blank class expression implies as parents: its fillers, and the items of its
    intersections, or the fillers of blank items."""
    filled = fillers(triples)
    heads = pairs(triples, V.INTERSECTION).select("onto_id", F.col("s").alias("node"), F.col("o").alias("head"))
    items = heads.join(list_items(triples, heads), ["onto_id", "head"])
    named = items.where("item_kind != 'bnode'").select("onto_id", "node", F.col("item").alias("parent"))
    inner = items.where("item_kind = 'bnode'").select("onto_id", F.col("node").alias("outer"), F.col("item").alias("node"))
    nested = inner.join(filled, ["onto_id", "node"]).select("onto_id", F.col("outer").alias("node"), "parent")
    return filled.select("onto_id", "node", "parent").unionByName(named).unionByName(nested).distinct()


def taxonomy(triples: DataFrame, class_set: DataFrame | None = None) -> DataFrame:
    """(onto_id, parent, child): edges of the class hierarchy.

    Self-loops stay in as edges with ``loop`` true: they give their parent no child, but the parent counts.
    """
    class_set = classes(triples) if class_set is None else class_set
    stated = pairs(triples, V.SUBCLASS, V.EQUIVALENT).select("onto_id", F.col("s").alias("child"), "o", "o_kind")
    direct = stated.where("o_kind != 'bnode'").select("onto_id", F.col("o").alias("parent"), "child")
    implied = stated.where("o_kind = 'bnode'").withColumnRenamed("o", "node").join(expression_parents(triples), ["onto_id", "node"])
    edges = direct.unionByName(implied.select("onto_id", "parent", "child")).where(F.col("parent") != V.THING).distinct()
    edges = edges.join(class_set.withColumnRenamed("iri", "parent"), ["onto_id", "parent"], "left_semi")
    edges = edges.join(class_set.withColumnRenamed("iri", "child"), ["onto_id", "child"], "left_semi")
    return edges.select("onto_id", "parent", "child", (F.col("parent") == F.col("child")).alias("loop"))


def breadth(edges: DataFrame) -> DataFrame:
    """(onto_id, parents, edges, roots, nodes, avg_branching) of a taxonomy."""
    per_parent = edges.groupBy("onto_id", "parent").agg(F.count_if(~F.col("loop")).alias("children"))
    real = edges.where("NOT loop")
    below = real.select("onto_id", F.col("child").alias("parent")).distinct()
    totals = per_parent.groupBy("onto_id").agg(F.count(F.lit(1)).alias("parents"), F.sum("children").alias("edges"))
    roots = per_parent.join(below, ["onto_id", "parent"], "left_anti").groupBy("onto_id").agg(F.count(F.lit(1)).alias("roots"))
    nodes = per_parent.select("onto_id", "parent").unionByName(below).distinct().groupBy("onto_id").agg(F.count(F.lit(1)).alias("nodes"))
    return (
        totals.join(roots, "onto_id", "left").join(nodes, "onto_id", "left")
        .select("onto_id", "parents", "edges", F.coalesce("roots", F.lit(0)).alias("roots"), "nodes", (F.col("edges") / F.col("parents")).alias("avg_branching"))
    )


def _longest_path(edges: Iterable[tuple[str, str]], parents: set[str], known: dict[str, int] | None = None) -> tuple[int, int]:
    """Longest downward path in nodes and the number of back edges cut, visiting nodes in sorted order.

    ``known`` are depths of children that are not walked.
    """
    below: dict[str, list[str]] = {p: [] for p in parents}
    for parent, child in edges:
        below[parent].append(child)
    for children in below.values():
        children.sort()
    depth: dict[str, int] = dict(known or {})
    cut = 0
    for root in sorted(below):
        if root in depth:
            continue
        path: list[tuple[str, int]] = [(root, 0)]
        open_nodes = {root}
        while path:
            node, at = path.pop()
            children = below.get(node, [])
            while at < len(children):
                child = children[at]
                at += 1
                if child in open_nodes and child not in depth:
                    depth[child] = 1  # a back edge: the node counts as a leaf until it closes
                    cut += 1
                elif child not in depth:
                    path.append((node, at))
                    path.append((child, 0))
                    open_nodes.add(child)
                    break
            else:
                depth[node] = 1 + max((depth.get(c, 1) for c in children), default=0)
                open_nodes.discard(node)
    return max((depth[p] for p in below), default=0), cut


#: After so many rounds of peeling, what is left is walked if no ontology has more edges left than WALKED_EDGES.
PEELED_ROUNDS = 64
WALKED_EDGES = 1_000_000


def depths(edges: DataFrame, rounds: int = PEELED_ROUNDS, walked_edges: int = WALKED_EDGES) -> DataFrame:
    """(onto_id, max_depth, back_edges) of each taxonomy.

    Leaves are peeled level by level, however many there are: an edge stays as long as its child has edges of its own, so a
    node is a parent in as many rounds as there are levels below it. When a round drops no edge, what is left lies on or above
    a cycle; that part alone is walked depth-first in sorted order, with the depths of the peeled children. Deep hierarchies
    may be walked from ``rounds`` on, if few enough edges are left; the result is the same.
    """
    edges = materialise(edges)
    real = edges.where("NOT loop").select("onto_id", "parent", "child")
    left, n, level, levels = real, real.count(), 0, None
    while n:
        level += 1
        parents = left.select("onto_id", F.col("parent").alias("n")).distinct()
        at = parents.withColumn("below", F.lit(level))
        levels = at if levels is None else levels.unionByName(at)
        left = materialise(left.join(parents.withColumnRenamed("n", "child"), ["onto_id", "child"], "left_semi"))
        before, n = n, left.count()
        if n == before:
            break
        if level % rounds == 0:
            levels = materialise(levels.groupBy("onto_id", "n").agg(F.max("below").alias("below")))
            most = left.groupBy("onto_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
            if most is not None and most <= walked_edges:
                break
    keys = edges.select("onto_id").distinct()
    if levels is None:
        return keys.select("onto_id", F.lit(1).alias("max_depth"), F.lit(0).alias("back_edges"))
    if not n:
        peeled = levels.groupBy("onto_id").agg((F.max("below") + 1).alias("max_depth"))
        return keys.join(peeled, "onto_id", "left").select("onto_id", F.coalesce("max_depth", F.lit(1)).alias("max_depth"), F.lit(0).alias("back_edges"))

    def walk(table: pa.Table) -> pa.Table:
        parents, children, depth = (table.column(c).to_pylist() for c in ("parent", "child", "depth"))
        found, cut = _longest_path(zip(parents, children, strict=True), set(parents), {c: d for c, d in zip(children, depth, strict=True) if d is not None})
        return pa.table({"onto_id": table.column("onto_id").slice(0, 1), "max_depth": pa.array([found], pa.int32()), "back_edges": pa.array([cut], pa.int32())})

    alive = left.select("onto_id", F.col("parent").alias("n")).distinct()
    known = materialise(levels.groupBy("onto_id", "n").agg((F.max("below") + 1).alias("depth")).join(alive.withColumn("open", F.lit(True)), ["onto_id", "n"], "left"))
    open_edges = real.join(alive.withColumnRenamed("n", "parent"), ["onto_id", "parent"], "left_semi")
    depth = F.when(F.col("open").isNull(), F.coalesce("depth", F.lit(1)))
    open_edges = open_edges.join(known.withColumnRenamed("n", "child"), ["onto_id", "child"], "left").select("onto_id", "parent", "child", depth.alias("depth"))
    walked = open_edges.groupBy("onto_id").applyInArrow(walk, "onto_id string, max_depth int, back_edges int")
    peeled = known.where("open IS NULL").groupBy("onto_id").agg(F.max("depth").alias("peeled"))
    both = keys.join(peeled, "onto_id", "left").join(walked, "onto_id", "left")
    return both.select("onto_id", F.coalesce(F.greatest("peeled", "max_depth"), F.lit(1)).alias("max_depth"), F.coalesce("back_edges", F.lit(0)).alias("back_edges"))


def top_counts(counts: DataFrame, key: str, k: int, count: str = "n") -> DataFrame:
    """The k largest counts of each ontology, ties by key."""
    order = Window.partitionBy("onto_id").orderBy(F.desc(count), F.col(key))
    return counts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def profile_by(triples: DataFrame, predicate_key: Column, name: str) -> DataFrame:
    return triples.groupBy("onto_id", predicate_key.alias(name)).agg(F.count(F.lit(1)).alias("n"))
