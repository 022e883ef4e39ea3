"""The queries over the driver's tables, and the same results in DuckDB's SQL.

Each query applies the library's operators to whole tables; each oracle is written on its own, over the same derived
triples and state tables (quillon.plans.testbed).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import vocab as V
from quillon.functions.stats import column_profile, describe_by, score_distribution
from quillon.functions.text import adequacy, cosine, escaped_html, floor_double, py_round, py_round_sql, sql_literal, tokens
from quillon.operators import graph as G
from quillon.operators import metrics as M
from quillon.plans import results as R
from quillon.plans import search as S
from quillon.plans import state as St
from quillon.plans import testbed as T
from quillon.plans.campaign import parity
from quillon.session import materialise
from quillon.sources import archives, registry, sniff

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _six(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# The parts that oracles share, as common table expressions.
_T = f"t AS MATERIALIZED ({T.plain(T.TRIPLES)})"
_CLASSES = (
    f"cls AS (SELECT DISTINCT onto_id, s AS iri FROM t WHERE p = '{V.TYPE}' AND o IN {_in(V.CLASS_TYPES)} AND s_kind = 'iri' "
    f"UNION SELECT onto_id, s FROM t WHERE p = '{V.SUBCLASS}' AND s_kind = 'iri' UNION SELECT onto_id, o FROM t WHERE p = '{V.SUBCLASS}' AND o_kind = 'iri')"
)
_INDIVIDUALS = (
    f"ind AS (SELECT DISTINCT t.onto_id, t.s AS iri FROM t JOIN cls ON cls.onto_id = t.onto_id AND cls.iri = t.o WHERE p = '{V.TYPE}' "
    "AND NOT EXISTS (SELECT 1 FROM cls c WHERE c.onto_id = t.onto_id AND c.iri = t.s))"
)
_ENTITIES = "ent AS (SELECT onto_id, iri, 'class' AS kind FROM cls UNION ALL SELECT onto_id, iri, 'individual' FROM ind)"
_ONTOS = "ontos AS (SELECT DISTINCT onto_id FROM t)"
_ANNOTATION = f"ann AS (SELECT DISTINCT onto_id, s AS p FROM t WHERE p = '{V.TYPE}' AND o = '{V.ANNOTATION}')"
_POPULATION = f"WITH RECURSIVE {_T}, {_CLASSES}, {_INDIVIDUALS}, {_ENTITIES}, {_ONTOS}, {_ANNOTATION}"
_OBJECTS = (
    f"op AS (SELECT onto_id, p FROM (SELECT DISTINCT onto_id, p FROM t WHERE o_kind <> 'literal' AND p NOT IN {_in(V.STRUCTURAL)} "
    f"UNION SELECT onto_id, s FROM t WHERE p = '{V.TYPE}' AND o = '{V.OBJECT_PROPERTY}') x "
    f"WHERE p NOT IN {_in(V.CONNECTION_ANNOTATIONS)} AND NOT EXISTS (SELECT 1 FROM ann a WHERE a.onto_id = x.onto_id AND a.p = x.p))"
)
_RLINKS = (
    f"rl AS (SELECT b.onto_id, b.s AS iri, o.o AS p FROM t r JOIN t o ON o.onto_id = r.onto_id AND o.s = r.s AND o.p = '{V.ON_PROPERTY}' "
    f"JOIN op ON op.onto_id = o.onto_id AND op.p = o.o JOIN t b ON b.onto_id = r.onto_id AND b.p = '{V.SUBCLASS}' AND b.o = r.s "
    f"JOIN cls ON cls.onto_id = b.onto_id AND cls.iri = b.s WHERE r.p = '{V.TYPE}' AND r.o = '{V.RESTRICTION}')"
)
_LINKS = (
    "lk AS (SELECT x.onto_id, x.iri, x.p FROM (SELECT t.onto_id, t.s AS iri, t.p FROM t JOIN op ON op.onto_id = t.onto_id AND op.p = t.p "
    "UNION ALL SELECT t.onto_id, t.o, t.p FROM t JOIN op ON op.onto_id = t.onto_id AND op.p = t.p) x "
    "JOIN ent ON ent.onto_id = x.onto_id AND ent.iri = x.iri UNION ALL SELECT onto_id, iri, p FROM rl)"
)
_LIST = (
    f"li AS (SELECT h.onto_id, h.o AS head, 0 AS position, h.o AS cell FROM (SELECT DISTINCT onto_id, o FROM t WHERE p = '{V.INTERSECTION}') h "
    f"UNION ALL SELECT li.onto_id, li.head, position + 1, r.o FROM li JOIN t r ON r.onto_id = li.onto_id AND r.s = li.cell AND r.p = '{V.REST}' WHERE r.o <> '{V.NIL}'), "
    f"items AS (SELECT li.onto_id, li.head, li.position, f.o AS item, f.o_kind AS item_kind FROM li JOIN t f ON f.onto_id = li.onto_id AND f.s = li.cell AND f.p = '{V.FIRST}')"
)
_EXPRESSIONS = (
    f"{_LIST}, fil AS (SELECT DISTINCT onto_id, s AS node, o AS parent FROM t WHERE p IN {_in(V.FILLERS)}), "
    f"hd AS (SELECT onto_id, s AS node, o AS head FROM t WHERE p = '{V.INTERSECTION}'), "
    "ex AS (SELECT onto_id, node, parent FROM fil UNION SELECT hd.onto_id, node, item FROM hd JOIN items USING (onto_id, head) WHERE item_kind <> 'bnode' "
    "UNION SELECT hd.onto_id, hd.node, fil.parent FROM hd JOIN items USING (onto_id, head) JOIN fil ON fil.onto_id = hd.onto_id AND fil.node = item WHERE item_kind = 'bnode')"
)
_TAXONOMY = (
    f"{_EXPRESSIONS}, st AS (SELECT onto_id, s AS child, o, o_kind FROM t WHERE p IN ('{V.SUBCLASS}', '{V.EQUIVALENT}')), "
    "raw AS (SELECT onto_id, o AS parent, child FROM st WHERE o_kind <> 'bnode' UNION SELECT st.onto_id, ex.parent, st.child FROM st JOIN ex ON ex.onto_id = st.onto_id AND ex.node = st.o WHERE o_kind = 'bnode'), "
    f"tax AS (SELECT raw.* FROM raw JOIN cls a ON a.onto_id = raw.onto_id AND a.iri = parent JOIN cls b ON b.onto_id = raw.onto_id AND b.iri = child WHERE parent <> '{V.THING}')"
)
_DEPTH = (
    "dp AS (SELECT DISTINCT onto_id, parent AS node, 1 AS depth FROM tax UNION SELECT tax.onto_id, tax.child, depth + 1 FROM dp JOIN tax ON tax.onto_id = dp.onto_id AND tax.parent = node WHERE parent <> child), "
    "mx AS (SELECT onto_id, max(depth) AS max_depth FROM dp GROUP BY onto_id)"
)
_BREADTH = (
    "pp AS (SELECT onto_id, parent, count(*) FILTER (parent <> child) AS children FROM tax GROUP BY ALL), "
    "br AS (SELECT onto_id, count(*) AS parents, sum(children)::BIGINT AS edges, sum(children) / count(*)::DOUBLE AS avg_branching FROM pp GROUP BY onto_id)"
)
_DEF_ORDER = "CASE p " + " ".join(f"WHEN '{p}' THEN {k}" for k, p in enumerate(V.DEFINITION_PROPERTIES)) + " END"
_DEFINITIONS = (
    f"df AS (SELECT onto_id, s AS iri, trim(string_agg(o, ' ' ORDER BY {_DEF_ORDER}, o)) AS definition FROM (SELECT DISTINCT t.onto_id, s, p, o FROM t JOIN ent ON ent.onto_id = t.onto_id AND ent.iri = t.s "
    f"WHERE p IN {_in(V.DEFINITION_PROPERTIES)}) x GROUP BY ALL)"
)
_TOKENS = "regexp_extract_all(lower(definition), '[\\p{L}\\p{N}_]+')"
_ADEQUACY = (
    f"CASE WHEN len({_TOKENS}) = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.4::DOUBLE * least(1.0::DOUBLE, len({_TOKENS}) / {V.MIN_TOKENS}::DOUBLE) "
    f"+ 0.6::DOUBLE * (1 - len(list_filter({_TOKENS}, lambda w: w IN {_in(V.STOP_WORDS)})) / len({_TOKENS})::DOUBLE))) END"
)
_COSINE = (
    "vec AS (SELECT a.vec_id // 2 AS k, list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) "
    "* sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))) AS c FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0), "
    f"cos AS ({T.plain(T.COSINES, cosine='vec').replace('count(*) / 2', 'count(*) // 2')})"
)
_VALUES = (
    f"{_COSINE}, {_DEFINITIONS}, dc AS (SELECT df.*, define_cosine, {_ADEQUACY} AS define_adequacy FROM df JOIN cos USING (onto_id, iri)), "
    "mu AS (SELECT onto_id, avg(define_cosine) AS m, stddev_pop(define_cosine) AS sd FROM dc GROUP BY onto_id), "
    "dv AS (SELECT dc.*, 1 / (1 + exp(-(define_cosine - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END)) AS define_match FROM dc JOIN mu USING (onto_id)), "
    "val AS (SELECT *, 0.4::DOUBLE * define_match + 0.6::DOUBLE * define_adequacy AS define_value FROM dv)"
)
_N = "n AS (SELECT onto_id, count(*) AS entities FROM ent GROUP BY onto_id)"
_SIGNALS = (
    f"sig AS (SELECT DISTINCT t.onto_id, s AS iri, t.p FROM t LEFT JOIN ann ON ann.onto_id = t.onto_id AND ann.p = t.p WHERE t.p IN {_in(V.DESCRIBE_SIGNALS)} OR ann.p IS NOT NULL), "
    f"xl AS (SELECT DISTINCT a.onto_id, a.s AS iri FROM t a JOIN t b ON b.onto_id = a.onto_id AND b.s = a.o AND b.p = '{V.XL_FORM}' WHERE a.p = '{V.XL_ALT_LABEL}'), "
    "des AS (SELECT ent.onto_id, ent.iri, count(sig.p) AS signals, count(sig.p) = 0 AND max(xl.iri) IS NOT NULL AS by_xl FROM ent LEFT JOIN sig ON sig.onto_id = ent.onto_id AND sig.iri = ent.iri "
    "LEFT JOIN xl ON xl.onto_id = ent.onto_id AND xl.iri = ent.iri GROUP BY ALL), "
    "dsc AS (SELECT onto_id, count(*) AS entities, count(*) FILTER (signals > 0 OR by_xl) AS described, count(*) FILTER (by_xl) AS by_xl FROM des GROUP BY onto_id)"
)
_CONNECTED = (
    f"pe AS (SELECT onto_id, iri, count(*) AS links, count(DISTINCT p) AS kinds FROM lk GROUP BY ALL), "
    f"cs AS (SELECT n.onto_id, n.entities, count(pe.iri) AS connected, count(pe.iri) / n.entities::DOUBLE AS coverage, "
    f"coalesce(sum(least(kinds, {V.MAX_DISTINCT})), 0) / {V.MAX_DISTINCT}::DOUBLE / n.entities AS diversity, "
    f"coalesce(sum(round(least(ln(links + 1) / ln({V.RICHNESS_BASE}), 1), 12)::DECIMAL(38, 12)), 0)::DOUBLE / n.entities AS richness "
    "FROM n LEFT JOIN pe USING (onto_id) GROUP BY n.onto_id, n.entities)"
)
_CONNECTION_SCORE = py_round_sql("10::DOUBLE * (0.7::DOUBLE * coverage + 0.2::DOUBLE * diversity + 0.1::DOUBLE * richness)")
_DESCRIBE_SCORE = py_round_sql("10::DOUBLE * described / entities")
_DEFINE_SCORE = f"coalesce({py_round_sql('10::DOUBLE * total / entities')}, 0)"
_FLAT_SCORE = "round_even((least(max_depth / 5::DOUBLE, 1) * 10 + least(avg_branching / 3::DOUBLE, 1) * 10) / 2, 0)"
_FOUR = (
    f"{_POPULATION}, {_OBJECTS}, {_RLINKS}, {_LINKS}, {_N}, {_SIGNALS}, {_CONNECTED}, {_VALUES}, {_TAXONOMY}, {_DEPTH}, {_BREADTH}, "
    "tot AS (SELECT n.onto_id, entities, sum(define_value::DECIMAL(38, 15))::DOUBLE AS total FROM n LEFT JOIN val USING (onto_id) GROUP BY ALL), "
    f"four AS (SELECT ontos.onto_id, {_DESCRIBE_SCORE.replace('entities', 'dsc.entities')} AS describe_score, {_DEFINE_SCORE.replace('entities', 'tot.entities')} AS define_score, "
    f"{_CONNECTION_SCORE} AS connection_score, {_FLAT_SCORE} AS flat_score FROM ontos JOIN dsc USING (onto_id) JOIN tot USING (onto_id) JOIN cs USING (onto_id) JOIN mx USING (onto_id) JOIN br USING (onto_id))"
)


def _cosines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    a = rows.where("vec_id % 2 = 0").select(F.expr("vec_id div 2").alias("k"), F.col("embedding").alias("a"))
    b = rows.where("vec_id % 2 = 1").select(F.expr("vec_id div 2").alias("k"), F.col("embedding").alias("b"))
    vectors = a.join(b, "k").select("k", cosine(F.col("a"), F.col("b")).alias("c"))
    return T.derived(spark, sf_dir, T.COSINES.replace("count(*) / 2", "count(*) div 2"), cosine=vectors)


def _defined(spark: SparkSession, sf_dir: str, triples: DataFrame, population: DataFrame) -> DataFrame:
    texts = M.definition_texts(triples, population).join(_cosines(spark, sf_dir), ["onto_id", "iri"])
    return M.defined(texts)


def _population(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes and entities, written once for a query that joins with them several times."""
    class_set = materialise(G.classes(triples))
    return class_set, materialise(G.entities(triples, class_set))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    class_set, people = _population(t)
    out = M.describe_score(t, people).select("onto_id", "describe_score")
    out = out.join(M.define_score(t, people, _defined(spark, sf_dir, t, people)).select("onto_id", "define_score"), "onto_id")
    out = out.join(M.connection_score(t, people, M.entity_links(t, people, class_set)).select("onto_id", "connection_score"), "onto_id")
    return out.join(M.flat_score(t, G.taxonomy(t, class_set)).select("onto_id", "flat_score"), "onto_id")


@query(f"{_POPULATION} SELECT onto_id, iri, iri NOT IN ('{V.THING}', '{V.NOTHING}') AS named FROM cls")
def class_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = G.classes(T.triples(spark, sf_dir))
    return found.withColumn("named", ~F.col("iri").isin(V.THING, V.NOTHING))


@query(f"{_POPULATION} SELECT onto_id, iri FROM ind")
def individuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.individuals(T.triples(spark, sf_dir)).select("onto_id", "iri")


@query(f"{_POPULATION} SELECT onto_id, kind, count(*) AS n FROM ent GROUP BY ALL")
def entity_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.entities(T.triples(spark, sf_dir)).groupBy("onto_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"{_POPULATION}, c AS (SELECT onto_id, p, count(*) AS n FROM t GROUP BY ALL) SELECT onto_id, p, n FROM c QUALIFY row_number() OVER (PARTITION BY onto_id ORDER BY n DESC, p) <= 40")
def predicate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.top_counts(G.profile_by(T.triples(spark, sf_dir), F.col("p"), "p"), "p", 40)


@query(
    f"{_POPULATION}, c AS (SELECT onto_id, o AS type, count(DISTINCT s) AS n FROM t WHERE p = '{V.TYPE}' GROUP BY ALL) "
    "SELECT onto_id, type, n FROM c QUALIFY row_number() OVER (PARTITION BY onto_id ORDER BY n DESC, type) <= 30"
)
def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = G.pairs(T.triples(spark, sf_dir), V.TYPE).groupBy("onto_id", F.col("o").alias("type")).agg(F.countDistinct("s").alias("n"))
    return G.top_counts(typed, "type", 30)


@query(
    f"{_POPULATION}, c AS (SELECT onto_id, coalesce(nullif(o_lang, ''), '(none)') AS lang, count(*) AS n FROM t WHERE p IN {_in((*V.LABEL_PROPERTIES, *V.DEFINITION_PROPERTIES))} AND o_kind = 'literal' GROUP BY ALL) "
    "SELECT onto_id, lang, n FROM c QUALIFY row_number() OVER (PARTITION BY onto_id ORDER BY n DESC, lang) <= 20"
)
def language_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.language_histogram(T.triples(spark, sf_dir))


@query(f"{_POPULATION} SELECT DISTINCT ent.onto_id, ent.iri FROM ent JOIN t ON t.onto_id = ent.onto_id AND t.s = ent.iri WHERE p = '{V.DEPRECATED}' AND lower(trim(o)) IN ('true', '1')")
def deprecated_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return M.deprecated_entities(t, G.entities(t))


_TYPED = lambda x: f"count(DISTINCT s) FILTER (p = '{V.TYPE}' AND o = '{x}')"


@query(
    f"{_POPULATION}, gone AS (SELECT ent.onto_id, count(DISTINCT ent.iri) AS g FROM ent JOIN t ON t.onto_id = ent.onto_id AND t.s = ent.iri WHERE p = '{V.DEPRECATED}' AND lower(trim(o)) IN ('true', '1') GROUP BY 1), "
    f"b AS (SELECT onto_id, count(*) AS triple_count, count(DISTINCT s) AS subjects, count(DISTINCT p) AS distinct_predicates, {_TYPED(V.ANNOTATION)} AS annotation_properties, "
    f"{_TYPED(V.OBJECT_PROPERTY)} AS object_properties_declared, {_TYPED(V.DATATYPE_PROPERTY)} AS datatype_properties_declared, {_TYPED(V.OWL + 'Class')} AS owl_classes_typed, "
    f"{_TYPED(V.RDFS + 'Class')} AS rdfs_classes_typed, {_TYPED(V.SKOS + 'Concept')} AS skos_concepts, {_TYPED(V.RESTRICTION)} AS owl_restrictions, "
    f"count(*) FILTER (p = '{V.SUBCLASS}') AS subclassof_triples, count(*) FILTER (p = '{V.EQUIVALENT}') AS equivalentclass_triples, "
    f"count(DISTINCT o) FILTER (p = '{V.IMPORTS}') AS owl_imports_count FROM t GROUP BY onto_id), "
    f"e AS (SELECT onto_id, count(*) FILTER (kind = 'class') AS classes, count(*) FILTER (kind = 'class' AND iri NOT IN ('{V.THING}', '{V.NOTHING}')) AS named_classes, "
    "count(*) FILTER (kind = 'individual') AS individuals, count(*) AS entities FROM ent GROUP BY onto_id) "
    "SELECT b.*, classes, named_classes, individuals, entities, coalesce(g, 0) AS deprecated_entities FROM b JOIN e USING (onto_id) LEFT JOIN gone USING (onto_id)"
)
def ontology_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return M.ontology_profile(t, G.entities(t))


@query(f"{_POPULATION} SELECT onto_id, count(DISTINCT o) AS owl_imports_count, array_to_string(list_sort(list(DISTINCT o))[:200], ' ') AS owl_imports FROM t WHERE p = '{V.IMPORTS}' GROUP BY 1")
def imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.imports(T.triples(spark, sf_dir)).withColumn("owl_imports", F.array_join("owl_imports", " ")).withColumn("owl_imports_count", F.col("owl_imports_count").cast("long"))


@query(f"{_POPULATION}, {_SIGNALS} SELECT onto_id, entities, described, by_xl, {_DESCRIBE_SCORE} AS describe_score FROM dsc")
def describe_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return M.describe_score(t, G.entities(t))


@query(
    f"{_POPULATION}, u AS (SELECT onto_id, p, count(*) AS n FROM (SELECT DISTINCT t.onto_id, s, p FROM t JOIN ent ON ent.onto_id = t.onto_id AND ent.iri = t.s) x GROUP BY ALL), "
    f"b AS (SELECT unnest([{', '.join(repr(p) for p in V.DESCRIBE_SIGNALS)}]) AS p) "
    "SELECT ontos.onto_id, b.p, true AS builtin, coalesce(n, 0) AS n FROM ontos CROSS JOIN b LEFT JOIN u ON u.onto_id = ontos.onto_id AND u.p = b.p "
    f"UNION ALL (SELECT ann.onto_id, ann.p, false, n FROM ann JOIN u ON u.onto_id = ann.onto_id AND u.p = ann.p WHERE ann.p NOT IN {_in(V.DESCRIBE_SIGNALS)} QUALIFY row_number() OVER (PARTITION BY ann.onto_id ORDER BY n DESC, ann.p) <= 50)"
)
def describe_signal_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return M.signal_usage(t, G.entities(t))


@query(f"{_POPULATION}, {_OBJECTS} SELECT onto_id, p FROM op")
def object_property_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.object_properties(T.triples(spark, sf_dir))


@query(f"{_POPULATION}, {_OBJECTS}, {_RLINKS} SELECT onto_id, iri, p, count(*) AS links FROM rl GROUP BY ALL")
def restriction_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.restriction_links(T.triples(spark, sf_dir))


@query(f"{_POPULATION}, {_OBJECTS}, {_RLINKS}, {_LINKS} SELECT onto_id, iri, count(*) AS connection_links, count(DISTINCT p) AS connection_distinct_properties FROM lk GROUP BY ALL")
def entity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return M.connected(M.entity_links(t, G.entities(t)))


@query(f"{_POPULATION}, {_OBJECTS}, {_RLINKS}, {_LINKS}, c AS (SELECT onto_id, p, count(*) AS n FROM lk GROUP BY ALL) SELECT onto_id, p, n FROM c QUALIFY row_number() OVER (PARTITION BY onto_id ORDER BY n DESC, p) <= 30")
def top_link_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    counts = M.entity_links(t, G.entities(t)).groupBy("onto_id", "p").agg(F.sum("links").alias("n"))
    return G.top_counts(counts, "p", 30)


@query(
    f"{_POPULATION}, {_OBJECTS}, {_RLINKS}, {_LINKS}, {_N}, {_CONNECTED} SELECT onto_id, entities, connected, round(coverage, 6) AS coverage, round(diversity, 6) AS diversity, "
    f"round(richness, 6) AS richness, {_CONNECTION_SCORE} AS connection_score FROM cs"
)
def connection_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return _six(M.connection_score(t, G.entities(t)), "coverage", "diversity", "richness")


@query(f"{_POPULATION}, {_LIST} SELECT onto_id, head, position, item, item_kind FROM items")
def rdf_list_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return G.list_items(t, G.pairs(t, V.INTERSECTION).select("onto_id", F.col("o").alias("head")))


@query(f"{_POPULATION}, {_EXPRESSIONS} SELECT onto_id, node, parent FROM ex")
def expression_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.expression_parents(T.triples(spark, sf_dir))


@query(f"{_POPULATION}, {_TAXONOMY} SELECT onto_id, parent, child FROM tax")
def taxonomy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.taxonomy(T.triples(spark, sf_dir)).select("onto_id", "parent", "child")


@query(
    f"{_POPULATION}, {_TAXONOMY}, {_BREADTH}, ch AS (SELECT DISTINCT onto_id, child FROM tax WHERE parent <> child), "
    "rt AS (SELECT pp.onto_id, count(*) AS roots FROM pp LEFT JOIN ch ON ch.onto_id = pp.onto_id AND ch.child = pp.parent WHERE ch.child IS NULL GROUP BY 1), "
    "nd AS (SELECT onto_id, count(*) AS nodes FROM (SELECT onto_id, parent FROM tax UNION SELECT onto_id, child FROM ch) GROUP BY 1) "
    "SELECT onto_id, parents, edges, coalesce(roots, 0) AS roots, nodes, round(avg_branching, 6) AS avg_branching FROM br LEFT JOIN rt USING (onto_id) JOIN nd USING (onto_id)"
)
def flat_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(G.breadth(G.taxonomy(T.triples(spark, sf_dir))), "avg_branching")


@query(f"{_POPULATION}, {_TAXONOMY}, {_DEPTH} SELECT onto_id, max_depth FROM mx")
def taxonomy_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.depths(G.taxonomy(T.triples(spark, sf_dir))).select("onto_id", "max_depth")


@query(f"{_POPULATION}, {_TAXONOMY}, {_DEPTH}, {_BREADTH} SELECT onto_id, max_depth, round(avg_branching, 6) AS avg_branching, {_FLAT_SCORE} AS flat_score FROM mx JOIN br USING (onto_id)")
def flat_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(M.flat_score(T.triples(spark, sf_dir)), "avg_branching").select("onto_id", "max_depth", "avg_branching", "flat_score")


@query(
    f"{_POPULATION}, b AS (SELECT t.onto_id, s AS iri, min(struct_pack(a := CASE WHEN p = '{V.PREF_LABEL}' THEN 0 ELSE 1 END, o := o)) AS m FROM t JOIN ent ON ent.onto_id = t.onto_id AND ent.iri = t.s "
    f"WHERE p IN {_in(V.LABEL_PROPERTIES)} GROUP BY ALL) SELECT ent.onto_id, ent.iri, coalesce(m.o, regexp_extract(regexp_extract(ent.iri, '[^#]*$'), '[^/]*$')) AS label, "
    "CASE WHEN m IS NULL THEN 'iri_local_name' WHEN m.a = 0 THEN 'skos:prefLabel' ELSE 'rdfs:label' END AS source FROM ent LEFT JOIN b ON b.onto_id = ent.onto_id AND b.iri = ent.iri"
)
def first_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    people = G.entities(t).select("onto_id", "iri")
    labels = G.first_labels(t, people).select("onto_id", F.col("s").alias("iri"), "label", "source")
    joined = people.join(labels, ["onto_id", "iri"], "left")
    return joined.select("onto_id", "iri", F.coalesce("label", M.label_fragment(F.col("iri"))).alias("label"), F.coalesce("source", F.lit("iri_local_name")).alias("source"))


@query(f"{_POPULATION}, {_DEFINITIONS} SELECT onto_id, iri, sha256(definition) AS definition_sha256, length(definition) AS chars FROM df")
def definition_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return M.definition_texts(t, G.entities(t)).select("onto_id", "iri", F.sha2("definition", 256).alias("definition_sha256"), F.length("definition").cast("long").alias("chars"))


@query(f"SELECT doc_id, len({_TOKENS}) AS tokens, round({_ADEQUACY}, 6) AS adequacy FROM (SELECT doc_id, text AS definition FROM documents)")
def adequacy_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "documents").select("doc_id", tokens(F.col("text")).alias("w"))
    return rows.select("doc_id", F.size("w").cast("long").alias("tokens"), F.round(adequacy(F.col("w")), 6).alias("adequacy"))


@query(f"WITH {_COSINE} SELECT onto_id, iri, round(define_cosine, 6) AS define_cosine FROM cos")
def label_definition_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(_cosines(spark, sf_dir), "define_cosine")


@query(f"{_POPULATION}, {_VALUES} SELECT onto_id, iri, round(define_match, 6) AS define_match, round(define_value, 6) AS define_value FROM val")
def match_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return _six(_defined(spark, sf_dir, t, G.entities(t)).select("onto_id", "iri", "define_match", "define_value"), "define_match", "define_value")


@query(
    f"{_POPULATION}, {_VALUES}, {_N}, a AS (SELECT onto_id, entities, count(val.iri) AS defined, sum(define_value::DECIMAL(38, 15))::DOUBLE AS total, round(avg(define_cosine), 6) AS cosine_mean, "
    f"round(stddev_pop(define_cosine), 6) AS cosine_std, count(*) FILTER (len({_TOKENS}) < {V.MIN_TOKENS}) AS short FROM n LEFT JOIN val USING (onto_id) GROUP BY ALL) "
    f"SELECT onto_id, entities, defined, cosine_mean, cosine_std, short, {_DEFINE_SCORE} AS define_score FROM a"
)
def define_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    people = G.entities(t)
    return _six(M.define_score(t, people, _defined(spark, sf_dir, t, people)), "cosine_mean", "cosine_std")


@query(
    f"{_POPULATION}, u AS (SELECT onto_id, p, count(*) AS uses, count(*) FILTER (o_kind = 'literal') AS texts FROM t WHERE p NOT IN {_in(V.DEFINITION_PROPERTIES)} GROUP BY ALL) "
    "SELECT onto_id, p, uses FROM u WHERE texts >= 0.8 * uses AND regexp_replace(lower(regexp_extract(CASE WHEN p LIKE '%#%' THEN regexp_extract(p, '[^#]*$') ELSE regexp_extract(p, '[^/]*$') END, '.*')), '[^a-z]', '', 'g') "
    f"IN {_in(V.DEFINITION_NAMES)}"
)
def define_property_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.detected_definition_properties(T.triples(spark, sf_dir))


@query(f"{_FOUR} SELECT onto_id, describe_score, define_score, connection_score, flat_score, round((describe_score + define_score + connection_score + flat_score) / 4, 6) AS core_average, "
       "CASE least(describe_score, define_score, connection_score, flat_score) WHEN describe_score THEN 'Describe' WHEN define_score THEN 'Define' WHEN connection_score THEN 'Connection' ELSE 'Flat' END AS weakest_metric FROM four")  # fmt: skip
def core_average_weakest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = M.averages(_scores(spark, sf_dir))
    return _six(out, "core_average").select("onto_id", *R.SCORES[:2], "connection_score", "flat_score", "core_average", "weakest_metric")


_TIPS = ", ".join(f"CASE WHEN {c} < 4 THEN '{name} Score is low (' || printf('%.2f', {py_round_sql(c)}) || '/10) because {reason}.' END" for c, name, reason in V.METRICS)


@query(f"{_FOUR} SELECT onto_id, coalesce(nullif(concat_ws('; ', {_TIPS}), ''), 'No suggestions') AS suggestions FROM four")
def suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.averages(_scores(spark, sf_dir)).select("onto_id", "suggestions")


@query(
    f"{_FOUR}, lk1 AS (SELECT onto_id, iri, count(*) AS links, count(DISTINCT p) AS kinds FROM lk GROUP BY ALL), "
    f"lb AS (SELECT t.onto_id, s AS iri, min(struct_pack(a := CASE WHEN p = '{V.PREF_LABEL}' THEN 0 ELSE 1 END, o := o)) AS m FROM t WHERE p IN {_in(V.LABEL_PROPERTIES)} GROUP BY ALL) "
    "SELECT ent.onto_id, ent.iri, kind, left(coalesce(m.o, regexp_extract(regexp_extract(ent.iri, '[^#]*$'), '[^/]*$')), 300) AS label, signals + CASE WHEN by_xl THEN 1 ELSE 0 END AS describe_signal_count, "
    "define_value IS NOT NULL AS has_definition, coalesce(length(definition), 0) AS definition_chars, round(coalesce(define_value, 0), 6) AS define_value, coalesce(links, 0) AS connection_links, "
    "coalesce(kinds, 0) AS connection_distinct_properties, coalesce(children, 0) AS taxonomy_children FROM ent JOIN des USING (onto_id, iri) LEFT JOIN val USING (onto_id, iri) "
    "LEFT JOIN lk1 USING (onto_id, iri) LEFT JOIN pp ON pp.onto_id = ent.onto_id AND pp.parent = ent.iri LEFT JOIN lb ON lb.onto_id = ent.onto_id AND lb.iri = ent.iri"
)
def entity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    class_set, people = _population(t)
    table = M.entity_table(t, people, _defined(spark, sf_dir, t, people), M.entity_links(t, people, class_set), G.taxonomy(t, class_set))
    return _six(table, "define_value").select(
        "onto_id", "iri", "kind", "label", "describe_signal_count", "has_definition", "definition_chars", "define_value", "connection_links",
        "connection_distinct_properties", "taxonomy_children",
    )


@query(
    "SELECT 'c_acctbal' AS metric, count(c_acctbal) AS n, round(avg(c_acctbal), 4) AS mean, round(stddev_pop(c_acctbal), 4) AS std, min(c_acctbal) AS min, round(quantile_cont(c_acctbal, 0.05), 4) AS p05, "
    "round(quantile_cont(c_acctbal, 0.25), 4) AS p25, round(quantile_cont(c_acctbal, 0.5), 4) AS median, round(quantile_cont(c_acctbal, 0.75), 4) AS p75, round(quantile_cont(c_acctbal, 0.95), 4) AS p95, max(c_acctbal) AS max FROM customer"
)
def score_distribution_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(score_distribution(T.table(spark, sf_dir, "customer"), ["c_acctbal"]), "mean", "std", "p05", "p25", "median", "p75", "p95")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


@query(
    "SELECT event_type, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min, round(quantile_cont(value, 0.5), 4) AS p50, "
    "round(quantile_cont(value, 0.9), 4) AS p90, round(quantile_cont(value, 0.95), 4) AS p95, max(value) AS max FROM events GROUP BY event_type"
)
def endpoint_latency_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(describe_by(T.table(spark, sf_dir, "events"), "event_type", "value"), "mean", "std", "p50", "p90", "p95")


_HITS = f"h AS ({T.plain(T.HITS)})"
_GROUPED = (
    f"{_HITS}, g AS (SELECT keyword, acronym, count(*) AS hits, min(rank) + 1 AS best_rank, arg_min(label, rank) AS example, bool_or(lower(label) = keyword OR lower(synonym) = keyword) AS exact, "
    "sum((1 / (rank + 1)::DOUBLE)::DECIMAL(38, 18))::DOUBLE + CASE WHEN bool_or(lower(label) = keyword OR lower(synonym) = keyword) THEN 1 ELSE 0 END AS raw FROM h WHERE acronym IS NOT NULL GROUP BY ALL), "
    "rel AS (SELECT *, floor(raw / max(raw) OVER (PARTITION BY keyword) * 1000 + 0.5) / 1000 AS relevance FROM g)"
)


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.derived(spark, sf_dir, T.HITS)
    return rows.select("keyword", "rank", "acronym", F.array("label").alias("pref_label"), F.array("synonym").alias("synonym"))


@query(f"WITH {_GROUPED} SELECT keyword, acronym, relevance, hits, exact, best_rank, example FROM rel")
def search_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.grouped_hits(_hits(spark, sf_dir))


_RANKED = (
    f"WITH {_GROUPED}, sc AS ({T.plain(T.SCORES)}), j AS (SELECT keyword, rel.acronym, relevance, coalesce(status, 'pending') AS status, CASE WHEN status = 'scored' THEN average_bp END AS average_bp, "
    "CASE WHEN status = 'scored' THEN described END AS described FROM rel LEFT JOIN sc ON sc.acronym = rel.acronym)"
)


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    serving = T.derived(spark, sf_dir, T.SCORES)
    matches = S.grouped_hits(_hits(spark, sf_dir)).select("keyword", "acronym", "relevance", "best_rank")
    joined = matches.join(F.broadcast(serving), "acronym", "left")  # a row for each source
    scored = F.col("status") == "scored"
    return joined.select("keyword", "acronym", "relevance", "best_rank", F.coalesce("status", F.lit("pending")).alias("status"), *[F.when(scored, F.col(c)).alias(c) for c in ("average_bp", "described")])


@query(
    f"{_RANKED} SELECT keyword, acronym, relevance, status, average_bp, described, CASE WHEN average_bp IS NOT NULL THEN rank() OVER (PARTITION BY keyword, average_bp IS NULL ORDER BY average_bp DESC) END AS rank_average_bp, "
    "CASE WHEN described IS NOT NULL THEN rank() OVER (PARTITION BY keyword, described IS NULL ORDER BY described DESC) END AS rank_described, count(*) FILTER (status = 'scored') OVER (PARTITION BY keyword) AS scored_count FROM j"
)
def search_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_ranks(_results(spark, sf_dir), ("average_bp", "described")).drop("best_rank")


@query(f"{_RANKED} SELECT keyword, acronym, described, row_number() OVER (PARTITION BY keyword ORDER BY coalesce(described, -1) DESC, relevance DESC, acronym) AS place FROM j")
def search_sort_missing_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("keyword").orderBy(F.coalesce(F.col("described"), F.lit(-1.0)).desc(), F.desc("relevance"), "acronym")
    return _results(spark, sf_dir).select("keyword", "acronym", "described", F.row_number().over(order).alias("place"))


_KEYWORDS = ("que des", "the", "und die", "covid-19", "licensed under the apache license", "de la")
_TERM_ROWS = ", ".join(f"('{k}', {i}, '{w}')" for k in _KEYWORDS for i, w in enumerate(k.split(" ")))
_WORD_LIST = "regexp_extract_all(translate(lower({}), '" + S._ACCENTED + "', '" + S._PLAIN + "'), '[\\p{{L}}\\p{{N}}]+')"
_BM25 = (
    f"WITH tm AS (SELECT * FROM (VALUES {_TERM_ROWS}) v(keyword, t, term)), d AS MATERIALIZED (SELECT doc_id, {_WORD_LIST.format('text')} AS w FROM documents), "
    f"tw AS (SELECT keyword, t, {_WORD_LIST.format('term')} AS q FROM tm), tot AS (SELECT count(*) AS docs, avg(len(w)) AS mean FROM d), "
    "wd AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS tok FROM d), "
    "tf AS (SELECT keyword, t, a.doc_id, count(*) AS tf FROM tw JOIN wd a ON a.tok = q[1] LEFT JOIN d ON d.doc_id = a.doc_id WHERE len(q) = 1 OR d.w[i + 1] = q[2] GROUP BY ALL), "
    "df AS (SELECT keyword, t, count(*) AS df FROM tf GROUP BY ALL), "
    "bm AS (SELECT keyword, doc_id, count(*) AS matched, -sum(greatest(1e-6, ln((docs - df + 0.5) / (df + 0.5))) * (tf * 2.2) / (tf + 1.2 * (1 - 0.75 + 0.75 * len(d.w) / mean))) AS score "
    "FROM tf JOIN df USING (keyword, t) JOIN d USING (doc_id), tot GROUP BY ALL)"
)


def _keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k,) for k in _KEYWORDS], "keyword string")


@query(f"{_BM25} SELECT keyword, doc_id, matched, round(score, 6) AS score FROM bm")
def bm25_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = S.bm25(S.query_terms(_keywords(spark)), T.table(spark, sf_dir, "documents"), ["text"], "doc_id")
    return _six(scores, "score")


@query(
    f"{_BM25}, sz AS (SELECT keyword, count(*) AS terms FROM tm GROUP BY 1), s AS (SELECT bm.keyword, doc_id, matched, terms, round(score, 9) AS score FROM bm JOIN sz USING (keyword)), "
    "ev AS (SELECT * FROM s WHERE matched = terms QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY score, doc_id) <= 40), "
    "few AS (SELECT sz.keyword FROM sz LEFT JOIN ev USING (keyword) WHERE sz.terms > 1 GROUP BY sz.keyword HAVING count(ev.doc_id) < 5), "
    "so AS (SELECT * FROM (SELECT * FROM s WHERE keyword IN (SELECT keyword FROM few) QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY score, doc_id) <= 40) x WHERE NOT EXISTS (SELECT 1 FROM ev WHERE ev.keyword = x.keyword AND ev.doc_id = x.doc_id)), "
    "al AS (SELECT keyword, doc_id, score, 0 AS pass FROM ev UNION ALL SELECT keyword, doc_id, score, 1 FROM so) "
    "SELECT keyword, doc_id, CASE WHEN min(score) OVER k < 0 THEN greatest(0.01, floor(score / min(score) OVER k * 1000 + 0.5) / 1000) ELSE 1 END AS relevance, row_number() OVER (PARTITION BY keyword ORDER BY pass, score, doc_id) AS best_rank "
    "FROM al WINDOW k AS (PARTITION BY keyword)"
)
def fallback_and_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.full_text(_keywords(spark), T.table(spark, sf_dir, "documents"), ["text"], "doc_id")


@query(
    "WITH b AS (SELECT user_id, max(ts) AS fetched_at, count(*) AS total_hits FROM events GROUP BY 1), n AS (SELECT max(ts) AS now FROM events), "
    "c AS (SELECT user_id AS keyword, CASE WHEN user_id % 5 = 0 THEN 'miss' WHEN epoch(now) - epoch(fetched_at) < 86400 THEN 'fresh' ELSE 'stale' END AS state, total_hits FROM b, n) "
    "SELECT keyword::VARCHAR AS keyword, CASE WHEN state = 'fresh' THEN 'cache' WHEN keyword % 2 = 0 THEN 'bioportal' WHEN state = 'stale' THEN 'stale_cache' ELSE 'fallback' END AS source, "
    "CASE WHEN state = 'fresh' THEN total_hits WHEN keyword % 2 = 0 THEN 7 WHEN state = 'stale' THEN total_hits END AS total_hits FROM c"
)
def cache_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = T.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    users = events.groupBy("user_id").agg(F.max("ts").alias("fetched_at"), F.count(F.lit(1)).alias("total_hits"))
    match = F.array(F.struct(F.col("keyword").alias("acronym")))
    cache = users.where("user_id % 5 <> 0").select(F.col("user_id").cast("string").alias("keyword"), F.lit("bioportal").alias("provider"), "total_hits", "fetched_at")
    keywords = users.select(F.col("user_id").cast("string").alias("keyword"))
    now = F.lit(events.agg(F.max("ts").cast("double")).first()[0]).cast("timestamp")
    state = S.cached(keywords, cache.withColumn("matches", match), now)
    live = users.where("user_id % 2 = 0").select(F.col("user_id").cast("string").alias("keyword"), F.lit(7).cast("long").alias("total_hits")).withColumn("matches", match)
    return S.cascade(state, live, keywords.withColumn("matches", match)).select("keyword", "source", "total_hits")


def _state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return T.derived(spark, sf_dir, T.CATALOG), T.derived(spark, sf_dir, T.DOWNLOADS), T.derived(spark, sf_dir, T.EVALUATIONS)


_STATE = f"WITH cat AS ({T.plain(T.CATALOG)}), dl AS ({T.plain(T.DOWNLOADS)}), ev AS ({T.plain(T.EVALUATIONS)})"


@query(
    f"{_STATE} SELECT dl.acronym, dl.submission_id, eval_bytes, ev.status AS eval_status, attempts AS eval_attempts, CASE WHEN ev.status IN {_in(St.RETRYABLE)} AND attempts >= 2 THEN 'gave_up' ELSE 'run' END AS action "
    f"FROM dl LEFT JOIN ev ON ev.acronym = dl.acronym AND ev.submission_id = dl.submission_id WHERE dl.status = 'ok' AND (ev.status IS NULL OR ev.status NOT IN {_in(St.TERMINAL)})"
)
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, downloads, evaluations = _state(spark, sf_dir)
    return St.work_queue(downloads, evaluations)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat, dl, ev = _state(spark, sf_dir)
    c = cat.select("acronym", "submission_id", F.col("status").alias("catalog_status"), F.col("error").alias("catalog_error"))
    d = dl.select("acronym", "submission_id", F.col("status").alias("download_status"), F.col("error").alias("download_error"), "eval_bytes")
    e = ev.withColumnRenamed("status", "eval_status").withColumnRenamed("error", "eval_error")
    average = (F.col("describe_score") + F.col("define_score") + F.col("connection_score") + F.col("flat_score")) / 4.0
    e = e.withColumn("core_average", average).withColumn("define_bp_source", F.lit(None).cast("string"))
    return R.completed(c.join(d, ["acronym", "submission_id"], "left").join(e, ["acronym", "submission_id"], "left"))


_JOINED = (
    f"{_STATE}, j AS (SELECT cat.acronym, cat.submission_id, cat.status AS cs, cat.error AS ce, dl.status AS ds, dl.error AS de, ev.status AS es, ev.error AS ee, ev.entities, describe_score, define_score, "
    "connection_score, flat_score, define_bp_score, (describe_score + define_score + connection_score + flat_score) / 4 AS core_average FROM cat LEFT JOIN dl ON dl.acronym = cat.acronym AND dl.submission_id = cat.submission_id "
    "LEFT JOIN ev ON ev.acronym = cat.acronym AND ev.submission_id = cat.submission_id), "
    "w AS (SELECT *, CASE WHEN cs = 'no_submission' THEN 'no_submission' WHEN es = 'done' AND entities = 0 THEN 'empty' WHEN es = 'parse_failed' AND starts_with(coalesce(ee, ''), 'not_an_ontology') THEN 'not_an_ontology' "
    + "".join(f"WHEN es = '{k}' THEN '{v}' " for k, v in R.WEB_STATUS.items())
    + "WHEN ds IN ('not_downloadable', 'private', 'summary_only') THEN 'not_downloadable' WHEN ds = 'skipped_too_large' THEN 'too_large' WHEN ds IS NOT NULL AND ds <> 'ok' THEN 'failed' ELSE 'pending' END AS web_status, "
    "CASE WHEN core_average IS NOT NULL THEN coalesce(define_bp_score, define_score) ELSE define_bp_score END AS bp FROM j)"
)


@query(f"{_JOINED} SELECT acronym, submission_id, web_status FROM w")
def web_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).select("acronym", "submission_id", "web_status")


@query(f"{_JOINED} SELECT web_status, count(*) AS n FROM w GROUP BY 1")
def web_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir).groupBy("web_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"{_JOINED} SELECT acronym, submission_id, entities, round(bp, 6) AS define_bp_score, CASE WHEN core_average IS NOT NULL AND define_bp_score IS NULL THEN '{R.UNCHECKED}' END AS define_bp_source, "
    "round((describe_score + bp + connection_score + flat_score) / 4, 6) AS core_average_bp FROM w"
)
def results_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(_joined(spark, sf_dir).select("acronym", "submission_id", "entities", "define_bp_score", "define_bp_source", "core_average_bp"), "define_bp_score", "core_average_bp")


@query(f"{_JOINED} SELECT acronym, web_status AS status, left(coalesce(nullif(ee, ''), nullif(de, ''), nullif(ce, '')), 300) AS status_detail, {py_round_sql('core_average', 4)} AS core_average FROM w")
def serving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _joined(spark, sf_dir)
    text = [c for c in "name bp_description bp_categories bp_language bp_version bp_released bp_url download_sha256 source_version core_version define_device eval_finished_at".split()]
    wide = rows.withColumns({c: F.lit(None).cast("string") for c in text} | {"provider": F.lit("bioportal"), "triple_count": F.lit(None).cast("long"), "classes": F.lit(None).cast("long")})
    return R.serving_rows(wide, F.current_timestamp()).select("acronym", "status", "status_detail", "core_average")


@query(f"{_STATE} SELECT acronym, submission_id, CASE WHEN status IN {_in(St.REQUEUED)} THEN 'pending' ELSE status END AS status, CASE WHEN status IN {_in(St.REQUEUED)} THEN 0 ELSE attempts END AS attempts FROM ev")
def requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return St.requeued(T.derived(spark, sf_dir, T.EVALUATIONS)).select("acronym", "submission_id", "status", "attempts")


@query(
    f"{_STATE} SELECT acronym, submission_id, CASE WHEN status = 'running' THEN CASE WHEN attempts >= 2 THEN 'gave_up' ELSE 'interrupted' END ELSE status END AS status, "
    "CASE WHEN status = 'running' THEN coalesce(error, '') || ' [session ended while running]' ELSE error END AS error FROM ev"
)
def interrupted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return St.interrupted(T.derived(spark, sf_dir, T.EVALUATIONS)).select("acronym", "submission_id", "status", "error")


_SERVING = "SELECT 'C' || CAST(c_custkey AS STRING) AS acronym, CASE WHEN c_custkey % 19 <> 0 THEN c_custkey % 6 + CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END END AS submission_id FROM {customer} WHERE c_custkey % 8 <> 0"
_DIFF = (
    f"{_STATE}, sv AS ({T.plain(_SERVING)}), x AS (SELECT cat.acronym, CASE WHEN sv.acronym IS NULL THEN 'new ontology' WHEN cat.status = 'ok' AND cat.submission_id <> coalesce(sv.submission_id, -1) "
    "THEN 'new submission (' || coalesce(sv.submission_id::VARCHAR, 'None') || ' -> ' || cat.submission_id::VARCHAR || ')' END AS reason FROM cat LEFT JOIN sv ON sv.acronym = cat.acronym)"
)


@query(f"{_DIFF} SELECT acronym, reason, row_number() OVER (ORDER BY acronym) > 60 AS deferred FROM x WHERE reason IS NOT NULL")
def nightly_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return St.nightly_diff(T.derived(spark, sf_dir, T.CATALOG), T.derived(spark, sf_dir, _SERVING))


_OLD = "SELECT 'p' AS provider, 'C' || CAST(c_custkey AS STRING) AS acronym, c_custkey % 5 AS submission_id, CASE WHEN c_custkey % 3 = 0 THEN 'failed' ELSE 'scored' END AS status, CAST(NULL AS STRING) AS status_detail, CAST(c_custkey % 10 AS DOUBLE) AS core_average, 'old' AS updated_at FROM {customer} WHERE c_custkey % 2 = 0"
_NEW = "SELECT 'p' AS provider, 'C' || CAST(c_custkey AS STRING) AS acronym, c_custkey % 5 + 1 AS submission_id, CASE c_custkey % 5 WHEN 0 THEN 'timed_out' WHEN 1 THEN 'failed' WHEN 2 THEN 'parse_failed' ELSE 'scored' END AS status, c_mktsegment AS status_detail, CAST(CASE WHEN c_custkey % 5 > 2 THEN c_custkey % 7 END AS DOUBLE) AS core_average, 'new' AS updated_at FROM {customer} WHERE c_custkey % 3 <> 1"


@query(
    f"WITH o AS ({T.plain(_OLD)}), n AS ({T.plain(_NEW)}), j AS (SELECT coalesce(n.acronym, o.acronym) AS acronym, n.acronym IS NULL AS only_old, coalesce(n.status IN ('timed_out', 'failed', 'too_large') AND o.status = 'scored', false) AS keep, o, n "
    "FROM o FULL JOIN n ON n.acronym = o.acronym) SELECT 'p' AS provider, acronym, CASE WHEN only_old OR keep THEN o.submission_id ELSE n.submission_id END AS submission_id, CASE WHEN only_old OR keep THEN o.status ELSE n.status END AS status, "
    "CASE WHEN only_old THEN o.status_detail WHEN keep THEN 'Submission ' || n.submission_id || ' is not scored yet (' || n.status || ' on the nightly runner); the scores shown are for submission ' || o.submission_id || '. Run it on the GPU machine.' ELSE n.status_detail END AS status_detail, "
    "CASE WHEN only_old OR keep THEN o.core_average ELSE n.core_average END AS core_average, CASE WHEN only_old THEN 'old' ELSE 'new' END AS updated_at FROM j"
)
def merge_keep_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    return St.merged_serving(T.derived(spark, sf_dir, _OLD), T.derived(spark, sf_dir, _NEW))


_PLAN_JSON = (
    "SELECT acronym, submission_id, CASE WHEN status = 'skipped' THEN 'done' ELSE status END AS status, CASE WHEN status = 'done' THEN '{{\"entities\": ' || CAST(entities AS STRING) || ', \"flat_cycle_back_edges\": ' || CAST(attempts AS STRING) || "
    "', \"flat_max_depth\": ' || CAST(submission_id AS STRING) || ', \"define_defined\": ' || CAST(entities * 3 AS STRING) || CASE WHEN define_bp_score IS NOT NULL THEN ', \"define_bp_score\": 1.5' ELSE '' END || '}}' END AS summary_json FROM "
)
_PLAN_CATALOG = (
    "SELECT acronym, CASE WHEN k % 5 = 0 THEN '{{\"definitionProperty\": \"http://example.com/def\"}}' WHEN k % 5 = 1 THEN '{{\"definitionProperty\": [\"http://www.w3.org/2000/01/rdf-schema#comment\", \"x\"]}}' END AS submission_json, "
    "'{{\"classes\": ' || CAST(k % 40 AS STRING) || ', \"classesWithNoDefinition\": ' || CAST(k % 7 AS STRING) || '}}' AS metrics_json FROM "
)


@query(
    f"{_STATE}, e AS (SELECT *, entities * 3 AS found FROM ev), k AS (SELECT acronym, k, k % 40 - k % 7 AS counted FROM cat), j AS (SELECT coalesce(dl.acronym, e.acronym) AS acronym, dl.status AS ds, e.status AS es, entities, attempts, e.submission_id AS depth, found, define_bp_score, counted, k "
    "FROM dl FULL JOIN e ON e.acronym = dl.acronym LEFT JOIN k ON k.acronym = coalesce(dl.acronym, e.acronym)), "
    "f AS (SELECT *, coalesce(es = 'done' AND entities = 0, false) AS emp, coalesce(es = 'done' AND entities > 0 AND define_bp_score IS NULL, false) AS opn FROM j), "
    "r AS (SELECT *, CASE WHEN opn THEN nullif(concat_ws('; ', CASE WHEN k % 5 = 0 THEN 'BioPortal definition property http://example.com/def' END, CASE WHEN counted >= 10 AND found < 0.5 * counted THEN 'BioPortal counts ' || counted || ' definitions, found ' || found END), '') END AS reasons FROM f) "
    "SELECT acronym, coalesce(ds IN ('failed', 'html_response', 'not_found'), false) AS download_failed, coalesce(es = 'parse_failed', false) AS parse_failed, emp AS empty, reasons IS NOT NULL AS define_candidate, reasons, "
    "opn AND attempts > 0 AND depth <= 6 AS flat_recheck, coalesce(es = 'done' AND entities > 0 AND define_bp_score IS NOT NULL, false) AS already_done FROM r"
)
def upgrade_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat, dl, ev = _state(spark, sf_dir)
    catalog = spark.sql(_PLAN_CATALOG + "{cat}", cat=cat)
    evaluations = spark.sql(_PLAN_JSON + "{ev}", ev=ev)
    return St.upgrade_plan(catalog, dl, evaluations)


@query("SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k, event_type AS tail FROM events")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "events")
    path = F.concat(F.lit("http://example.com/a/"), F.col("event_type"), F.lit("//"))
    return rows.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), R.tail(path).alias("tail"))


@query(
    "SELECT page_id, CASE WHEN trim(html) = '' THEN 'empty' WHEN contains(low, '<rdf:rdf') THEN 'xml' WHEN starts_with(low, '<!doctype html') OR starts_with(low, '<html') THEN 'html' WHEN starts_with(low, '<?xml') THEN 'xml' END AS format, "
    "'not_an_ontology:html' AS error FROM (SELECT page_id, html, lower(ltrim(html)) AS low FROM pages)"
)
def format_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    told = rows.withColumn("format", sniff.sniffed(F.col("content")))
    return told.select("page_id", "format", sniff.unsupported(F.col("format")).alias("error"))


@query("SELECT doc_id, sha256(text) AS sha256, left(sha256(text), 32) AS short FROM documents")
def sha_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return rows.withColumn("short", F.substring("sha256", 1, 32))


@query(
    f"{_POPULATION}, v AS (SELECT onto_id, s, min(o) AS version FROM t WHERE p = '{V.VERSION}' GROUP BY ALL), o AS (SELECT onto_id, min(s) AS s FROM t WHERE p = '{V.TYPE}' AND o = '{V.ONTOLOGY}' GROUP BY 1) "
    "SELECT ontos.onto_id, coalesce(o.s, 'anonymous') AS ontology_iri, coalesce(version, 'filehash:unknown') AS version_iri FROM ontos LEFT JOIN o USING (onto_id) LEFT JOIN v ON v.onto_id = o.onto_id AND v.s = o.s"
)
def ontology_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.identity(T.triples(spark, sf_dir))


@query(
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM customer" for c, t in (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")))
)
def data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(T.table(spark, sf_dir, "customer"))


@query(
    "WITH b AS (SELECT 'P' || p_partkey AS acronym, p_size * 6000 AS bp_classes FROM part), k AS (SELECT acronym, CASE WHEN bp_classes < 1000 THEN 0 WHEN bp_classes < 20000 THEN 1 WHEN bp_classes < 200000 THEN 2 ELSE 3 END AS bin, sha256('7:' || acronym) AS h FROM b), "
    "f AS (SELECT acronym, bin, h, 0 AS stage FROM k QUALIFY row_number() OVER (PARTITION BY bin ORDER BY h, acronym) <= 5), r AS (SELECT acronym, bin, h, 1 AS stage FROM k WHERE acronym NOT IN (SELECT acronym FROM f)) "
    "SELECT acronym, bin FROM (SELECT * FROM f UNION ALL SELECT * FROM r) ORDER BY stage, h, acronym LIMIT 20"
)
def stratified_pilot(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = T.table(spark, sf_dir, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("acronym"), (F.col("p_size") * 6000).alias("bp_classes"))
    return St.pilot(parts)


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'NULL' ELSE '''' || replace(c_name || '''s', '''', '''''') || '''' END AS name_sql, CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '0' END AS flag_sql, c_nationkey::VARCHAR AS number_sql FROM customer")
def sql_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") % 5 != 0, F.concat("c_name", F.lit("'s")))
    return rows.select("c_custkey", sql_literal(name, "string").alias("name_sql"), sql_literal(F.col("c_custkey") % 2 == 0, "boolean").alias("flag_sql"), sql_literal(F.col("c_nationkey"), "int").alias("number_sql"))


@query("SELECT c_custkey, CASE WHEN v >= 7 THEN 'good' WHEN v >= 5 THEN 'mid' WHEN v IS NOT NULL THEN 'low' END AS band, CASE WHEN v IS NULL THEN 'n/a' ELSE printf('%.2f', v) END AS shown, least(100, greatest(0, coalesce(v, 0) * 10)) AS width FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN floor(c_acctbal / 10) / 100 END AS v FROM customer)")
def score_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("c_custkey") % 9 != 0, floor_double(F.col("c_acctbal") / 10) / 100.0)
    return T.table(spark, sf_dir, "customer").select("c_custkey", M.quality_band(value).alias("band"), S.shown(value).alias("shown"), S.bar_width(value).alias("width"))


@query("SELECT page_id, replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS url FROM pages")
def html_escaping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "pages").select("page_id", escaped_html(F.col("url")).alias("url"))


@query(f"SELECT l_orderkey, l_linenumber, {py_round_sql('l_extendedprice * l_discount / 7')} AS rounded FROM lineitem")
def python_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", py_round(F.col("l_extendedprice") * F.col("l_discount") / 7).alias("rounded"))


_LABEL_SOURCE = (
    f"lb AS (SELECT t.onto_id, s AS iri, min(CASE WHEN p = '{V.PREF_LABEL}' THEN 0 ELSE 1 END) AS a FROM t WHERE p IN {_in(V.LABEL_PROPERTIES)} GROUP BY ALL), "
    "dd AS (SELECT onto_id, iri FROM df WHERE definition <> '')"
)


@query(
    f"{_POPULATION}, {_DEFINITIONS}, {_LABEL_SOURCE} SELECT dd.onto_id, CASE a WHEN 0 THEN 'skos:prefLabel' WHEN 1 THEN 'rdfs:label' ELSE 'iri_local_name' END AS source, count(*) AS n "
    "FROM dd LEFT JOIN lb ON lb.onto_id = dd.onto_id AND lb.iri = dd.iri GROUP BY ALL"
)
def label_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return M.label_sources(t, M.definition_texts(t, G.entities(t)))


@query(
    f"{_POPULATION}, {_DEFINITIONS}, {_LABEL_SOURCE} SELECT dd.onto_id, p, count(DISTINCT dd.iri) AS n FROM dd JOIN t ON t.onto_id = dd.onto_id AND t.s = dd.iri WHERE p IN {_in(V.DEFINITION_PROPERTIES)} GROUP BY ALL"
)
def definition_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    return M.definition_sources(t, M.definition_texts(t, G.entities(t)))


#: One list of all orders, and one of three cells that bites its tail.
_LONG_LIST = (
    f"SELECT 'long' AS onto_id, 'c' || CAST(o_orderkey AS STRING) AS s, 'bnode' AS s_kind, '{V.FIRST}' AS p, o_orderpriority AS o, 'literal' AS o_kind FROM {{orders}} "
    f"UNION ALL SELECT 'long', 'c' || CAST(o_orderkey AS STRING), 'bnode', '{V.REST}', coalesce('c' || CAST(lead(o_orderkey) OVER (ORDER BY o_orderkey) AS STRING), '{V.NIL}'), 'bnode' FROM {{orders}} "
    f"UNION ALL SELECT 'cycle', 'x' || CAST(r_regionkey AS STRING), 'bnode', '{V.FIRST}', r_name, 'literal' FROM {{region}} WHERE r_regionkey < 3 "
    f"UNION ALL SELECT 'cycle', 'x' || CAST(r_regionkey AS STRING), 'bnode', '{V.REST}', 'x' || CAST((r_regionkey + 1) % 3 AS STRING), 'bnode' FROM {{region}} WHERE r_regionkey < 3"
)


@query(
    "SELECT 'long' AS onto_id, min('c' || o_orderkey) FILTER (o_orderkey = first) OVER () AS head, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, o_orderpriority AS item, 'literal' AS item_kind "
    "FROM orders, (SELECT min(o_orderkey) AS first FROM orders) UNION ALL SELECT 'cycle', 'x1', (r_regionkey + 2) % 3, r_name, 'literal' FROM region WHERE r_regionkey < 3"
)
def rdf_list_walk_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = T.table(spark, sf_dir, "orders").agg(F.min("o_orderkey")).select(F.lit("long").alias("onto_id"), F.concat(F.lit("c"), F.col("min(o_orderkey)").cast("string")).alias("head"))
    heads = first.unionByName(spark.createDataFrame([("cycle", "x1")], "onto_id string, head string"))
    return G.list_items(T.derived(spark, sf_dir, _LONG_LIST), heads)


@query(f"{_FOUR}, a AS (SELECT *, (describe_score + define_score + connection_score + flat_score) / 4 AS av, least(describe_score, define_score, connection_score, flat_score) AS lo FROM four), "
       "w AS (SELECT *, CASE lo WHEN describe_score THEN 'Describe' WHEN define_score THEN 'Define' WHEN connection_score THEN 'Connection' ELSE 'Flat' END AS weak, "
       f"printf('%.2f', {py_round_sql('av')}) AS avs, printf('%.2f', {py_round_sql('lo')}) AS los FROM a) "
       "SELECT onto_id, CASE WHEN av >= 8 THEN 'This ontology scores well across all dimensions (average ' || avs || '/10). The main area to improve is ' || weak || ' (' || los || '/10).' "
       "WHEN av >= 5 THEN 'This ontology has mixed quality (average ' || avs || '/10). The weakest dimension is ' || weak || ' (' || los || '/10).' "
       "ELSE 'This ontology scores low overall (average ' || avs || '/10). Several dimensions need work, starting with ' || weak || ' (' || los || '/10).' END AS summary_banner FROM w")  # fmt: skip
def summary_banner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.averages(_scores(spark, sf_dir)).select("onto_id", "summary_banner")


_QUEUE = (
    f"q AS (SELECT dl.acronym, dl.submission_id, eval_bytes, CASE WHEN ev.status IN {_in(St.RETRYABLE)} AND attempts >= 2 THEN 'gave_up' ELSE 'run' END AS action "
    f"FROM dl LEFT JOIN ev ON ev.acronym = dl.acronym AND ev.submission_id = dl.submission_id WHERE dl.status = 'ok' AND (ev.status IS NULL OR ev.status NOT IN {_in(St.TERMINAL)}))"
)


@query(f"{_STATE}, {_QUEUE} SELECT action, count(*) AS files, count(*) FILTER (eval_bytes IS NULL) AS unknown, sum(coalesce(eval_bytes, 0))::BIGINT AS bytes FROM q GROUP BY 1")
def queue_size_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, downloads, evaluations = _state(spark, sf_dir)
    return St.size_totals(St.work_queue(downloads, evaluations))


@query(
    f"{_STATE}, {_QUEUE} SELECT * FROM (SELECT 'first' AS unknown, acronym, submission_id FROM q ORDER BY eval_bytes ASC NULLS FIRST, acronym LIMIT 40) "
    "UNION ALL SELECT * FROM (SELECT 'last', acronym, submission_id FROM q ORDER BY eval_bytes ASC NULLS LAST, acronym LIMIT 40)"
)
def queue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, downloads, evaluations = _state(spark, sf_dir)
    queue = St.work_queue(downloads, evaluations)
    heads = [St.in_order(queue, last).limit(40).select(F.lit(name).alias("unknown"), "acronym", "submission_id") for name, last in (("first", False), ("last", True))]
    return heads[0].unionByName(heads[1])


@query("SELECT event_type AS acronym, value AS eval_seconds, event_id FROM events WHERE value IS NOT NULL ORDER BY value DESC, event_type LIMIT 15")
def slowest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.slowest(T.table(spark, sf_dir, "events").select(F.col("event_type").alias("acronym"), F.col("value").alias("eval_seconds"), "event_id"))


@query(f"{_GROUPED.replace('h AS', 'WITH h AS', 1)} SELECT keyword, acronym, concat_ws(', ', CASE WHEN hits > 0 THEN hits || ' matching term' || CASE WHEN hits = 1 THEN '' ELSE 's' END END, "
       "CASE WHEN exact THEN 'exact name match' WHEN coalesce(example, '') <> '' THEN 'for example \"' || example || '\"' END) AS why FROM rel")  # fmt: skip
def match_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.grouped_hits(_hits(spark, sf_dir)).select("keyword", "acronym", S.explanation().alias("why"))


@query(
    "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN '#' || c_custkey % 9 || ' of ' || 9 ELSE '' END AS rank_text, "
    + "CASE status " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.STATUS_TEXTS.items())
    + " ELSE 'Not scored' END AS status_text FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'scored' WHEN 2 THEN 'other' END AS status FROM customer)"
)
def rank_and_status_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    status = F.when(k % 4 == 0, "empty").when(k % 4 == 1, "scored").when(k % 4 == 2, "other")
    rank = S.rank_text(F.when(k % 4 != 0, k % 9), F.lit(9))
    return T.table(spark, sf_dir, "customer").select("c_custkey", rank.alias("rank_text"), S.status_text(status).alias("status_text"))


@query(
    f"{_STATE} SELECT acronym, submission_id, CASE WHEN status = 'crashed' THEN 'running' ELSE status END AS status, CASE WHEN status = 'crashed' THEN attempts + 1 ELSE attempts END AS attempts, "
    "CASE WHEN status = 'crashed' THEN 'r9' END AS run_id, CASE WHEN status <> 'crashed' THEN error END AS error FROM ev"
)
def started_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = F.lit(None).cast("string")
    rows = T.derived(spark, sf_dir, T.EVALUATIONS).withColumns({c: null for c in ("started_at", "run_id", "error_type", "traceback", "stage_at_failure")})
    return St.started(rows, rows.where("status = 'crashed'"), "r9", F.lit("now")).select("acronym", "submission_id", "status", "attempts", "run_id", "error")


@query("SELECT c_custkey, 'DELETE FROM ontology_search WHERE provider = ''p'' AND acronym = ''' || c_name || ''';' AS value, 0 AS at FROM customer UNION ALL "
       "SELECT c_custkey, 'INSERT INTO ontology_search (provider, acronym, name, description, categories) VALUES (''p'', ''' || c_name || ''', ''' || c_mktsegment || ''', NULL, ''it''''s'');', 1 FROM customer")  # fmt: skip
def full_text_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.table(spark, sf_dir, "customer")
    rows = c.select(F.lit("p").alias("provider"), F.col("c_name").alias("acronym"), F.col("c_mktsegment").alias("name"), F.lit(None).cast("string").alias("description"), F.lit("it's").alias("categories"))
    found = R.full_text_refresh(rows).join(c.select("c_custkey", F.col("c_name").alias("acronym")), "acronym")
    return found.select("c_custkey", "value", "at")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their number as ``k`` and as acronym."""
    rows = T.table(spark, sf_dir, "customer")
    return rows.select("*", F.col("c_custkey").alias("k"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("acronym"))


def _text_of(*parts: Column | str) -> Column:
    """Parts side by side; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


_CUSTOMERS = "c AS (SELECT *, c_custkey AS k, 'C' || c_custkey AS acronym FROM customer)"


@query(
    f"WITH {_CUSTOMERS} SELECT acronym, CASE WHEN k % 5 = 0 THEN 'private' ELSE 'public' END AS bp_viewing_restriction, k % 7 = 0 AS bp_summary_only, k % 4 < 2 AS bp_is_view, "
    "CASE k % 4 WHEN 0 THEN 'C' || k WHEN 1 THEN 'V' || k END AS bp_view_of, 'A;B' || k % 3 AS bp_categories, '' AS bp_groups, c_mktsegment AS bp_language, '1.' || k AS bp_version, "
    "'production;beta' AS bp_submission_status, CASE WHEN k % 2 = 0 THEN 'en;fr' ELSE 'en' END AS bp_natural_language, least(5000, k % 3 * 2600) AS description_chars, "
    "CASE WHEN k % 3 = 0 THEN '' ELSE 'Ann;None' END AS bp_contact_names, k AS bp_classes, NULL::BIGINT AS bp_max_depth, 'https://bioportal.bioontology.org/ontologies/C' || k AS bp_url FROM c"
)
def catalog_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, null = F.col("k"), F.lit(None).cast("string")
    view = F.when(k % 4 == 0, _text_of('"http://x/ontologies/C', k, '/"')).when(k % 4 == 1, _text_of('{"acronym": "V', k, '"}')).when(k % 4 == 2, '""').otherwise("null")
    domain = _text_of("http://x/categories/B", k % 3)
    onto = _text_of(
        '{"viewingRestriction": "', F.when(k % 5 == 0, "private").otherwise("public"), '", "summaryOnly": ', k % 7 == 0, ', "viewOf": ', view,
        ', "hasDomain": ["', domain, '", {"name": "A"}, "', domain, '"], "group": []}',
    )
    sub = _text_of(
        '{"hasOntologyLanguage": "', F.col("c_mktsegment"), '", "version": "1.', k, '", "submissionStatus": ["production", "beta"], "naturalLanguage": ',
        F.when(k % 2 == 0, '["en", "fr"]').otherwise('"en"'), ', "description": "', F.expr("repeat('d', cast(k % 3 * 2600 AS INT))"), '", "contact": ',
        F.when(k % 3 == 0, "null").otherwise('[{"name": "Ann"}, {"email": "x"}]'), "}",
    )
    rows = _customers(spark, sf_dir).select(
        "acronym", F.col("c_name").alias("name"), F.lit(1).cast("long").alias("submission_id"), F.lit("ok").alias("status"), null.alias("error"), null.alias("fetched_at"),
        onto.alias("ontology_json"), sub.alias("submission_json"), _text_of('{"classes": ', k, ', "maxDepth": "x"}').alias("metrics_json"),
    )
    return R.catalog_frame(rows).select(
        "acronym", "bp_viewing_restriction", "bp_summary_only", "bp_is_view", "bp_view_of", "bp_categories", "bp_groups", "bp_language", "bp_version", "bp_submission_status",
        "bp_natural_language", F.length("bp_description").cast("long").alias("description_chars"), "bp_contact_names", "bp_classes", "bp_max_depth", "bp_url",
    )


_ENRICHED = (
    f"WITH {_GROUPED}, sc AS ({T.plain(T.SCORES)}), j AS (SELECT keyword, rel.acronym, relevance, hits, exact, best_rank, sc.acronym IS NOT NULL AS known, coalesce(status, 'pending') AS status, "
    "CASE WHEN status = 'scored' THEN average_bp END AS average_bp, CASE WHEN status = 'scored' THEN described END AS \"describe\" FROM rel LEFT JOIN sc ON sc.acronym = rel.acronym)"
)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = F.lit(None)
    texts = ("name", "ontology_language", "version", "released", "registry_url", "status_detail", "define_bp_source", "evaluated_at")
    scores = ("define_score", "define_bp_score", "connection_score", "flat_score", "core_average")
    serving = T.derived(spark, sf_dir, T.SCORES).select(
        "acronym", "status", F.col("described").alias("describe_score"), F.col("average_bp").alias("core_average_bp"), F.expr("repeat('z', 500)").alias("description"),
        F.lit("a;;b").alias("categories"), *[F.lit("" if c in ("name", "registry_url") else None).cast("string").alias(c) for c in texts],
        *[null.cast("double").alias(c) for c in scores], null.cast("long").alias("entity_count"), null.cast("long").alias("triple_count"),
    )
    return S.enriched(S.grouped_hits(_hits(spark, sf_dir)), serving)


@query(
    f"{_ENRICHED} SELECT keyword, acronym, relevance, hits, exact, best_rank, acronym AS name, status, CASE WHEN NOT known THEN '{S.PENDING_DETAIL}' END AS status_detail, average_bp, \"describe\", "
    "NULL::DOUBLE AS define, CASE WHEN known THEN repeat('z', 400) END AS description, CASE WHEN known THEN 'a,b' ELSE '' END AS categories, 'https://bioportal.bioontology.org/ontologies/' || acronym AS registry_url FROM j"
)
def enriched_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir).select(
        "keyword", "acronym", "relevance", "hits", "exact", "best_rank", "name", "status", "status_detail", "average_bp", "describe", "define", "description",
        F.array_join("categories", ",").alias("categories"), "registry_url",
    )


@query(
    f"{_ENRICHED} SELECT keyword, 'live' AS source, count(*) AS n, count(*) FILTER (status = 'scored') AS scored_count, string_agg(acronym, ',' ORDER BY relevance DESC, best_rank, acronym) AS acronyms, "
    "string_agg(status, ',' ORDER BY relevance DESC, best_rank, acronym) AS statuses FROM j GROUP BY 1"
)
def answer_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = S.with_ranks(_enriched(spark, sf_dir))
    sources = ranked.select("keyword").distinct().select("keyword", F.lit("live").alias("source"), F.lit(None).cast("string").alias("note"), F.lit(None).cast("long").alias("total_hits"))
    body = F.from_json("body", "struct<source: string, count: bigint, scored_count: bigint, results: array<struct<acronym: string, status: string>>>")
    told = S.payload(ranked, sources).select("keyword", body.alias("b"))
    return told.select(
        "keyword", "b.source", F.col("b.count").alias("n"), "b.scored_count", F.array_join("b.results.acronym", ",").alias("acronyms"), F.array_join("b.results.status", ",").alias("statuses")
    )


@query(
    f"WITH {_CUSTOMERS} SELECT k, CASE WHEN k % 4 = 3 THEN 'a b ' || k ELSE CASE WHEN k % 4 = 1 THEN repeat('x', 201) WHEN k % 4 = 2 THEN repeat('x', 200) ELSE '' END END AS q, "
    "CASE k % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'too_long' END AS error FROM c"
)
def keyword_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    text = F.when(k % 4 == 3, _text_of("  A \t b ", k, " ")).when(k % 4 == 1, "x" * 201).when(k % 4 == 2, "X" * 200).when(k % 8 == 0, " ")
    return S.valid_keywords(_customers(spark, sf_dir).select("k", text.alias("keyword"))).select("k", "q", "error")


@query(
    f"WITH {_HITS}, n AS (SELECT keyword, acronym, count(*) AS n, min(rank) AS first FROM h WHERE acronym IS NOT NULL GROUP BY ALL), "
    "top AS (SELECT keyword, string_agg(acronym, ';' ORDER BY n DESC, first, acronym) AS top_ontologies FROM (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY n DESC, first, acronym) <= 10) GROUP BY 1) "
    "SELECT 'search' AS endpoint, keyword, count(*) AS result_count, count(DISTINCT acronym) AS distinct_ontologies, any_value(top_ontologies) AS top_ontologies FROM h LEFT JOIN top USING (keyword) GROUP BY keyword"
)
def endpoint_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.latency(_hits(spark, sf_dir).withColumn("endpoint", F.lit("search")))


@query(
    f"{_STATE} SELECT acronym, submission_id, CASE WHEN status <> 'done' THEN status WHEN attempts % 2 = 0 THEN 'done' WHEN attempts >= {St.MAX_ATTEMPTS} THEN 'gave_up' ELSE 'crashed' END AS status, "
    "CASE WHEN status = 'done' AND attempts % 2 = 0 THEN 5.0 WHEN status <> 'done' THEN describe_score END AS describe_score, CASE WHEN status <> 'done' THEN flat_score END AS flat_score, "
    "CASE WHEN status <> 'done' THEN error WHEN attempts % 2 = 1 THEN 'boom' END AS error, attempts FROM ev"
)
def finished_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    null = F.lit(None).cast("string")
    rows = T.derived(spark, sf_dir, T.EVALUATIONS).withColumns({"summary_json": null, "result_path": null, "entities_path": null, "core_average": F.lit(1.0), "flat_score": F.col("flat_score").cast("double")})
    good = F.col("attempts") % 2 == 0
    results = rows.where("status = 'done'").select(
        *St.KEY, F.when(good, "done").otherwise("crashed").alias("status"), F.lit(5.0).alias("describe_score"), F.when(~good, "boom").alias("error")
    )
    return St.finished(rows, results).select("acronym", "submission_id", "status", "describe_score", "flat_score", "error", "attempts")


@query("SELECT o_custkey::VARCHAR AS acronym, max(o_orderkey) AS submission_id, arg_max(o_orderpriority, o_orderkey) AS status FROM orders GROUP BY 1")
def latest_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("acronym"), F.col("o_orderkey").alias("submission_id"), F.col("o_orderpriority").alias("status"))
    return St.latest(rows)


@query(f"WITH {_CUSTOMERS} SELECT acronym FROM c WHERE (k % 5 <> 0 AND k % 4 = 2 AND k % 3 <> 0) OR k % 50 = 1")
def rescored_acronyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    source = F.when(k % 4 == 0, "").when(k % 4 == 1, "same_as_strict").otherwise("p: found")
    score = F.when(k % 4 == 3, "").otherwise(', "define_bp_score": 1.5')
    version = F.when(k % 3 == 0, ', "core4_version": "2"').when(k % 3 == 1, ', "core4_version": "1"').otherwise("")
    rows = _customers(spark, sf_dir)
    runs = rows.select("acronym", F.when(k % 5 == 0, "error").otherwise("done").alias("status"), _text_of('{"define_bp_source": "', source, '"', score, version, "}").alias("summary_json"))
    plan = rows.select("acronym", (k % 100 == 1).alias("define_candidate"), (k % 100 == 51).alias("flat_recheck"))
    return St.rescoring(plan, runs, "2")


@query(
    f"WITH {_CUSTOMERS}, x AS (SELECT acronym, k, CASE WHEN k % 3 <> 0 THEN ['original:submission'] ELSE [] END AS own, list_filter([CASE WHEN k % 4 = 0 OR k % 5 = 0 THEN CASE WHEN k % 6 < 2 THEN 'http://h/a.owl' END END, "
    "CASE WHEN k % 4 = 0 OR k % 5 = 0 THEN 'http://purl.obolibrary.org/obo/c' || k || '.owl' END], lambda u: u IS NOT NULL) AS urls FROM c) "
    "SELECT acronym, 0 AS at, 'original:submission' AS variant, '/ontologies/' || acronym || '/submissions/' || k || '/download' AS url, false AS external FROM x WHERE len(own) = 1 UNION ALL "
    "SELECT acronym, len(own) + i, 'obo_owl:' || i, urls[i + 1], true FROM x, range(2) r(i) WHERE i < len(urls)"
)
def alternate_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    pull = F.when(k % 6 == 0, "http://h/a.obo").when(k % 6 == 1, "http://h/a.owl").when(k % 6 == 2, "ftp://h/a.owl").otherwise("")
    rows = _customers(spark, sf_dir).select(
        "acronym", k.alias("submission_id"), F.when(k % 3 == 0, "original:x").when(k % 3 == 1, "latest").alias("variant"), F.when(k % 4 == 0, "obo").alias("sniffed_format"),
        _text_of('{"hasOntologyLanguage": "', F.when(k % 5 == 0, "obo").otherwise("OWL"), '", "pullLocation": "', pull, '"}').alias("submission_json"),
    )
    return St.alternate_sources(rows)


@query(f"WITH {_CUSTOMERS} SELECT acronym FROM c WHERE k % 3 <> 0 AND k % 7 <> 0 AND k % 11 <> 0 AND k % 5 <> 0")
def eligible_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    rows = _customers(spark, sf_dir).select(
        "acronym", F.when(k % 3 == 0, "error").otherwise("ok").alias("catalog_status"), F.when(k % 7 == 0, "private").when(k % 2 == 0, "public").alias("bp_viewing_restriction"),
        F.when(k % 11 == 0, True).when(k % 2 == 1, False).alias("bp_summary_only"), k.alias("bp_classes"),
    )
    known = _customers(spark, sf_dir).where(k % 5 == 0).select("acronym", F.when(k % 2 == 0, "ok").otherwise("no_submission").alias("status"))
    return St.incremental_todo(St.eligible(rows).select("acronym"), known)


@query(
    "SELECT c_custkey AS k, 'INSERT OR REPLACE INTO scores (k, name, flag, balance) VALUES (' || c_custkey || ', ''' || c_name || '''''s'', ' || CASE WHEN c_custkey % 3 = 0 THEN 'NULL' WHEN c_custkey % 3 = 1 THEN '1' ELSE '0' END "
    "|| ', ' || CASE WHEN c_custkey % 4 = 0 THEN 'NULL' ELSE c_acctbal::VARCHAR END || ');' AS value FROM customer"
)
def insert_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    rows = _customers(spark, sf_dir).select("k", _text_of(F.col("c_name"), "'s").alias("name"), F.when(k % 3 != 0, k % 3 == 1).alias("flag"), F.when(k % 4 != 0, F.col("c_acctbal")).alias("balance"))
    number = F.regexp_extract("value", r"VALUES \((\d+)", 1).cast("long")
    return R.insert_statements(rows, "scores").select(number.alias("k"), "value")


@query(
    "SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN 'f' || c_custkey || '.owl' WHEN 1 THEN 'a b' || c_custkey || '.ttl' WHEN 2 THEN 'é' || c_custkey || '.obo' WHEN 3 THEN 'say \"x\".rdf' END AS name FROM customer"
)
def server_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    header = (
        F.when(k % 5 == 0, _text_of("attachment; filename=f", k, ".owl")).when(k % 5 == 1, _text_of('attachment; filename="a b', k, '.ttl"; size=1'))
        .when(k % 5 == 2, _text_of("attachment; filename=plain.obo; filename*=UTF-8''%C3%A9", k, ".obo")).when(k % 5 == 3, r'attachment; filename="say \"x\".rdf"')
    )
    return _customers(spark, sf_dir).select("k", archives.server_filename(F.when(k % 10 == 4, "inline").otherwise(header)).alias("name"))


@query(
    "SELECT c_name AS keyword, 0 AS rank, 'C' || c_custkey AS acronym, 'L' || c_custkey AS pref_label, 'a;b' AS synonym FROM customer UNION ALL SELECT c_name, 1, NULL, '', 'one' FROM customer"
)
def answered_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    body = _text_of(
        '{"collection": [{"prefLabel": "L', k, '", "synonym": ["a", "b"], "links": {"ontology": "http://x/ontologies/C', k, '/"}}, {"prefLabel": null, "synonym": "one", "links": {}}], "totalCount": 2}'
    )
    rows = registry.search_hits(_customers(spark, sf_dir).select(F.col("c_name").alias("keyword"), body.alias("body")))
    return rows.select("keyword", "rank", "acronym", F.array_join("pref_label", ";").alias("pref_label"), F.array_join("synonym", ";").alias("synonym"))


@query(
    "SELECT 'C' || c_custkey AS onto_id, 'define_score' AS metric, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS got, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS want "
    "FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 11 = 0 UNION ALL SELECT 'C' || c_custkey, m, NULL, 1.0 FROM customer, (VALUES ('describe_score'), ('connection_score'), ('flat_score')) v(m) WHERE c_custkey % 11 = 0"
)
def parity_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, balance, one = F.col("k"), F.col("c_acctbal"), F.lit(1.0)
    others = [one.alias(c) for c in ("describe_score", "connection_score", "flat_score")]
    rows = _customers(spark, sf_dir)
    scores = rows.where(k % 11 != 0).select(F.col("acronym").alias("onto_id"), balance.alias("define_score"), *others)
    expected = rows.select(F.col("acronym").alias("onto_id"), F.when(k % 10 == 0, balance + 1).otherwise(balance).alias("define_score"), *others)
    return parity(scores, expected)


_DECLARED = (("terms#definition", 0), ("terms#other", 2))


@query(
    f"{_POPULATION}, u AS (SELECT onto_id, p, count(*) AS uses, count(*) FILTER (o_kind = 'literal') AS texts FROM t WHERE p = '{T._E}terms#definition' GROUP BY ALL), d AS (SELECT onto_id, uses FROM u WHERE texts >= 0.8 * uses), "
    "o AS (SELECT DISTINCT onto_id FROM t) SELECT onto_id, v.p, v.place, false AS literal_only, NULL AS source FROM o, (VALUES "
    + ", ".join(f"('{p}', {i})" for i, p in enumerate(V.DEFINITION_PROPERTIES))
    + f") v(p, place) UNION ALL SELECT onto_id, '{T._E}terms#definition', {len(V.DEFINITION_PROPERTIES)}, true, 'bioportal_definitionProperty' || CASE WHEN uses IS NULL THEN '' ELSE ' + detected_by_name' END FROM o LEFT JOIN d USING (onto_id) "
    f"UNION ALL SELECT onto_id, '{T._E}terms#other', {len(V.DEFINITION_PROPERTIES) + 2}, true, 'bioportal_definitionProperty' FROM o "
    f"UNION ALL SELECT onto_id, '{V.NOT_DEFINITION_TEXT[1]}', NULL, true, 'ignored: links to a defining document, not definition text' FROM o"
)
def declared_definition_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.triples(spark, sf_dir)
    listed = [(T._E + name, at) for name, at in _DECLARED] + [(V.NOT_DEFINITION_TEXT[1], 1), (V.DEFINITION_PROPERTIES[0], 3)]
    declared = t.select("onto_id").distinct().withColumn("x", F.explode(F.array(*[F.struct(F.lit(i).alias("iri"), F.lit(a).alias("at")) for i, a in listed])))
    return M.bp_definition_properties(t, declared.select("onto_id", "x.iri", "x.at"))


@query(
    f"WITH {_T}, n AS (SELECT onto_id, p, count(*) AS n FROM t GROUP BY onto_id, p QUALIFY row_number() OVER (PARTITION BY onto_id ORDER BY n DESC, p) <= 5) "
    "SELECT onto_id, string_agg(p || '=' || n, ',' ORDER BY n DESC, p) AS counts FROM n GROUP BY 1"
)
def predicate_count_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = M.counted(G.profile_by(T.triples(spark, sf_dir), F.col("p"), "p"), "p", 5)
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select("onto_id", F.array_join(entries, ",").alias("counts"))


QUERIES["score_distribution"] = QUERIES.pop("score_distribution_query")
ORACLES["score_distribution"] = ORACLES.pop("score_distribution_query")
