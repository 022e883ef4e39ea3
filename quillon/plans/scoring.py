"""One plan for all ontologies: triples to the summary row of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon import vocab as V
from quillon.functions.encoder import hashing
from quillon.functions.text import py_round
from quillon.operators import graph as G
from quillon.operators import metrics as M
from quillon.session import materialise

VERSION = "1.0"
KEY = "onto_id"


def summary(triples: DataFrame, declared: DataFrame | None = None, encoder: Callable[[Column], Column] = hashing) -> DataFrame:
    """Scores, averages, texts and statistics, a row an ontology.

    ``declared`` (onto_id, iri, at): definition properties that the registry knows of. An ontology without further
    definition properties keeps its strict Define, and its texts are encoded once.
    """
    # Several scores join with these sets, so they are written once.
    class_set = materialise(G.classes(triples))
    people = materialise(G.entities(triples, class_set))
    strict = M.defined(M.with_cosines(M.definition_texts(triples, people), triples, encoder))
    define = M.define_score(triples, people, strict)
    declared = triples.sparkSession.createDataFrame([], "onto_id string, iri string, at int") if declared is None else declared
    listed = M.bp_definition_properties(triples, declared)
    extra = listed.where(f"literal_only AND place >= {len(V.DEFINITION_PROPERTIES)}")
    wider = extra.select(KEY).distinct()
    told = listed.where("source IS NOT NULL").groupBy(KEY).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("place", F.lit(-1)).alias("place"), "p", "source"))), lambda x: F.concat(x["p"], F.lit(": "), x["source"])), "; ").alias("told")
    )
    some = triples.join(wider, KEY, "left_semi")
    props = listed.where("place IS NOT NULL").join(wider, KEY, "left_semi").select(KEY, "p", "place", "literal_only")
    group = people.join(wider, KEY, "left_semi")
    texts = M.definition_texts(some, group, props)
    define_bp = M.define_score(some, group, M.defined(M.with_cosines(texts, some, encoder)))
    define_bp = define_bp.select(KEY, F.col("define_score").alias("_bp"), F.col("defined").alias("_bp_defined"))
    out = (
        M.describe_score(triples, people).withColumnRenamed("described", "describe_described").drop("entities", "by_xl")
        .join(define.select(KEY, "define_score", F.col("defined").alias("define_defined"), F.col("cosine_mean").alias("define_cosine_mean"), F.col("cosine_std").alias("define_cosine_std")), KEY)
        .join(M.connection_score(triples, people, M.entity_links(triples, people, class_set)).select(KEY, "connection_score", F.col("coverage").alias("connection_coverage"), F.col("diversity").alias("connection_diversity"), F.col("richness").alias("connection_richness"), F.col("connected").alias("connection_connected")), KEY)
        .join(M.flat_score(triples, G.taxonomy(triples, class_set)).select(KEY, "flat_score", F.col("max_depth").alias("flat_max_depth"), F.col("avg_branching").alias("flat_avg_branching"), F.col("parents").alias("flat_parents"), F.col("edges").alias("flat_edges"), F.col("back_edges").alias("flat_cycle_back_edges")), KEY)
        .join(define_bp, KEY, "left").join(told, KEY, "left").join(M.ontology_profile(triples, people), KEY).join(M.identity(triples), KEY)
    )
    out = M.averages(out).withColumns(
        {
            "define_bp_score": F.coalesce("_bp", "define_score"), "define_bp_defined": F.coalesce("_bp_defined", "define_defined"),
            "define_bp_source": F.coalesce("told", F.lit("same_as_strict")), "empty_ontology": F.col("entities") == 0, "core_version": F.lit(VERSION),
        }
    )
    average = (F.col("describe_score") + F.col("define_bp_score") + F.col("connection_score") + F.col("flat_score")) / 4.0
    return out.withColumn("core_average_bp", average).withColumn("core_average_bp_2dp", py_round(F.col("core_average_bp"))).drop("_bp", "_bp_defined", "told")
