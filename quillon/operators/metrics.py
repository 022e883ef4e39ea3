"""The four scores per ontology, and what stands behind them per entity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon import vocab as V
from quillon.functions.text import adequacy, cosine, label_fragment, local_name, py_round, stripped, tokens
from quillon.operators import graph as G
from quillon.session import materialise

KEYS = ["onto_id", "iri"]


def _ontologies(triples: DataFrame) -> DataFrame:
    return triples.select("onto_id").distinct()


def _signals(triples: DataFrame) -> Column:
    return F.col("p").isin(*V.DESCRIBE_SIGNALS)


def described(triples: DataFrame, population: DataFrame) -> DataFrame:
    """(onto_id, iri, describe_signal_count, described, by_xl): distinct signal predicates of each entity; an entity without
    any counts as described if it has an extended label with a literal form."""
    used = triples.where(_signals(triples)).select("onto_id", F.col("s").alias("iri"), "p")
    declared = triples.join(G.annotation_properties(triples), ["onto_id", "p"], "left_semi").select("onto_id", F.col("s").alias("iri"), "p")
    counts = used.unionByName(declared).distinct().groupBy(*KEYS).agg(F.count(F.lit(1)).alias("signals"))
    forms = G.pairs(triples, V.XL_FORM).select("onto_id", F.col("s").alias("o")).distinct()
    extended = G.pairs(triples, V.XL_ALT_LABEL).join(forms, ["onto_id", "o"], "left_semi").select("onto_id", F.col("s").alias("iri")).distinct()
    joined = population.join(counts, KEYS, "left").join(extended.withColumn("xl", F.lit(True)), KEYS, "left")
    by_xl = F.col("signals").isNull() & F.coalesce("xl", F.lit(False))
    n = F.coalesce("signals", F.lit(0)) + F.when(by_xl, 1).otherwise(0)
    return joined.select(*KEYS, n.cast("long").alias("describe_signal_count"), (n > 0).alias("described"), by_xl.alias("by_xl"))


def describe_score(triples: DataFrame, population: DataFrame) -> DataFrame:
    """(onto_id, entities, described, by_xl, describe_score)."""
    sums = described(triples, population).groupBy("onto_id").agg(
        F.count(F.lit(1)).alias("entities"), F.count_if("described").alias("described"), F.count_if("by_xl").alias("by_xl")
    )
    score = py_round(10.0 * F.col("described") / F.col("entities"))
    return _whole(triples, sums, {"entities": 0, "described": 0, "by_xl": 0}, describe_score=score)


def _whole(triples: DataFrame, sums: DataFrame, zeros: dict, **scores: Column) -> DataFrame:
    """All ontologies: those without entities have zero counts and score 0."""
    some = sums.select(*sums.columns, *[c.alias(k) for k, c in scores.items()])
    joined = _ontologies(triples).join(some, "onto_id", "left")
    return joined.select("onto_id", *[F.coalesce(c, F.lit(zeros.get(c, 0.0))).alias(c) for c in some.columns if c != "onto_id"])


def signal_usage(triples: DataFrame, population: DataFrame) -> DataFrame:
    """(onto_id, p, builtin, n): entities that use each signal; built-in signals also where none does."""
    own = triples.join(population.select("onto_id", F.col("iri").alias("s")), ["onto_id", "s"], "left_semi").select("onto_id", "s", "p").distinct()
    counts = own.groupBy("onto_id", "p").agg(F.count(F.lit(1)).alias("n"))
    declared = G.annotation_properties(triples).where(~F.col("p").isin(*V.DESCRIBE_SIGNALS))
    all_builtin = _ontologies(triples).select("onto_id", F.explode(F.array(*[F.lit(p) for p in V.DESCRIBE_SIGNALS])).alias("p"))
    first = all_builtin.join(counts, ["onto_id", "p"], "left").select("onto_id", "p", F.lit(True).alias("builtin"), F.coalesce("n", F.lit(0)).alias("n"))
    second = declared.join(counts, ["onto_id", "p"]).select("onto_id", "p", F.lit(False).alias("builtin"), "n")
    return first.unionByName(G.top_counts(second, "p", 50))


def definition_texts(triples: DataFrame, population: DataFrame, properties: DataFrame | None = None) -> DataFrame:
    """(onto_id, iri, definition): values of the definition properties joined by a space, trimmed.

    Values are ordered by the property's place in the list and then by value. ``properties`` (onto_id, p, place, literal_only)
    replaces the built-in list.
    """
    if properties is None:
        place = F.lit(len(V.DEFINITION_PROPERTIES))
        for k, p in enumerate(V.DEFINITION_PROPERTIES):
            place = F.when(F.col("p") == p, k).otherwise(place)
        values = G.pairs(triples, *V.DEFINITION_PROPERTIES).withColumn("place", place)
    else:
        values = triples.join(properties, ["onto_id", "p"]).where("NOT literal_only OR o_kind = 'literal'")
    values = values.join(population.select("onto_id", F.col("iri").alias("s")), ["onto_id", "s"], "left_semi")
    values = values.select("onto_id", "s", "place", "o").distinct()
    parts = values.groupBy("onto_id", F.col("s").alias("iri")).agg(F.array_sort(F.collect_list(F.struct("place", "o"))).alias("v"))
    text = stripped(F.array_join(F.transform("v", lambda x: x["o"]), " "))
    return parts.select(*KEYS, text.alias("definition")).where("definition != ''")


def with_cosines(texts: DataFrame, triples: DataFrame, encoder, cut: int = 128) -> DataFrame:
    """Adds ``define_cosine``: of the encoder's vectors of label and definition (see quillon.functions.encoder)."""
    labels = G.first_labels(triples).select("onto_id", F.col("s").alias("iri"), "label")
    named = texts.join(labels, KEYS, "left").withColumn("label", F.coalesce("label", label_fragment(F.col("iri"))))
    coded = named.withColumn("_a", encoder(F.col("label"))).withColumn("_b", encoder(F.col("definition")))
    return coded.withColumn("define_cosine", cosine(F.col("_a"), F.col("_b"))).drop("_a", "_b", "label")


def defined(texts: DataFrame, min_tokens: int = V.MIN_TOKENS) -> DataFrame:
    """Per defined entity: tokens, adequacy, match of the cosine within its ontology, and the value of both.

    ``texts`` has onto_id, iri, definition, define_cosine. Mean and population deviation are an aggregate joined back, not a
    window, so one large ontology is no single task.
    """
    words = texts.withColumn("_t", tokens(F.col("definition"))).select(
        *KEYS, "define_cosine", F.length("definition").alias("definition_chars"),
        F.size("_t").alias("definition_word_tokens"), adequacy(F.col("_t"), min_tokens).alias("define_adequacy"),
    )
    spread = texts.groupBy("onto_id").agg(F.avg("define_cosine").alias("mu"), F.stddev_pop("define_cosine").alias("sd"))
    z = (F.col("define_cosine") - F.col("mu")) / F.when(F.col("sd") == 0, 1.0).otherwise(F.col("sd"))
    joined = words.join(spread, "onto_id").withColumn("define_match", 1.0 / (1.0 + F.exp(-z)))
    return joined.withColumn("define_value", 0.4 * F.col("define_match") + 0.6 * F.col("define_adequacy"))


def define_score(triples: DataFrame, population: DataFrame, values: DataFrame) -> DataFrame:
    """(onto_id, defined, cosine_mean, cosine_std, define_score): the mean over all entities, undefined ones count 0."""
    n = population.groupBy("onto_id").agg(F.count(F.lit(1)).alias("entities"))
    sums = values.groupBy("onto_id").agg(
        F.count(F.lit(1)).alias("defined"), F.first("mu").alias("cosine_mean"), F.first("sd").alias("cosine_std"),
        F.sum(F.col("define_value").cast("decimal(38,15)")).cast("double").alias("total"),
        F.count_if(F.col("definition_word_tokens") < V.MIN_TOKENS).alias("short"),
    )
    joined = _ontologies(triples).join(n, "onto_id", "left").join(sums, "onto_id", "left")
    score = F.coalesce(py_round(10.0 * F.col("total") / F.col("entities")), F.lit(0.0))
    return joined.select(
        "onto_id", F.coalesce("entities", F.lit(0)).alias("entities"), F.coalesce("defined", F.lit(0)).alias("defined"),
        "cosine_mean", "cosine_std", F.coalesce("short", F.lit(0)).alias("short"), score.alias("define_score"),
    )


def definition_sources(triples: DataFrame, values: DataFrame, properties: DataFrame | None = None) -> DataFrame:
    """(onto_id, p, n): of the defined entities (``values``: onto_id, iri), how many have each definition property, whatever its value is."""
    if properties is None:
        uses = G.pairs(triples, *V.DEFINITION_PROPERTIES)
    else:
        uses = triples.join(properties.select("onto_id", "p"), ["onto_id", "p"], "left_semi")
    own = uses.select("onto_id", F.col("s").alias("iri"), "p").join(values.select(*KEYS), KEYS, "left_semi")
    return own.groupBy("onto_id", "p").agg(F.countDistinct("iri").alias("n"))


def label_sources(triples: DataFrame, values: DataFrame) -> DataFrame:
    """(onto_id, source, n): where the labels of the defined entities come from."""
    found = G.first_labels(triples, values).select("onto_id", F.col("s").alias("iri"), "source")
    named = values.select(*KEYS).join(found, KEYS, "left").withColumn("source", F.coalesce("source", F.lit("iri_local_name")))
    return named.groupBy("onto_id", "source").agg(F.count(F.lit(1)).alias("n"))


def counted(counts: DataFrame, key: str, k: int | None = None, count: str = "n") -> DataFrame:
    """(onto_id, counts): a map of key to count for each ontology, the largest ``k`` if given, largest first and ties by key."""
    listed = F.array_sort(F.collect_list(F.struct((-F.col(count)).alias("minus"), F.col(key).alias("key"), F.col(count).alias("n"))))
    top = (G.top_counts(counts, key, k, count) if k is not None else counts).groupBy("onto_id").agg(listed.alias("l"))
    return top.select("onto_id", F.map_from_entries(F.transform("l", lambda x: F.struct(x["key"], x["n"]))).alias("counts"))


def cut_counts(triples: DataFrame, texts: DataFrame, pieces: Callable[[Column], Column], most: int = 128) -> DataFrame:
    """(onto_id, short, cut_definitions, cut_labels): definitions under the least number of words, and texts that fill an encoder.

    ``texts``: onto_id, iri, definition; ``pieces`` counts the encoder's pieces of a text, its marks included.
    """
    labels = G.first_labels(triples, texts).select("onto_id", F.col("s").alias("iri"), "label")
    named = texts.join(labels, KEYS, "left").withColumn("label", F.coalesce("label", label_fragment(F.col("iri"))))
    return named.groupBy("onto_id").agg(
        F.count_if(F.size(tokens(F.col("definition"))) < V.MIN_TOKENS).alias("short"),
        F.count_if(pieces(F.col("definition")) >= most).alias("cut_definitions"), F.count_if(pieces(F.col("label")) >= most).alias("cut_labels"),
    )


def detected_definition_properties(triples: DataFrame) -> DataFrame:
    """(onto_id, p, uses): properties named or labelled as definition that hold text in at least 80 % of their uses.

    The share is taken over all uses, not over a head of them, so it doesn't hang on an order.
    """
    uses = triples.where(~F.col("p").isin(*V.DEFINITION_PROPERTIES)).groupBy("onto_id", "p").agg(
        F.count(F.lit(1)).alias("uses"), F.count_if(F.col("o_kind") == "literal").alias("texts")
    )
    labels = G.pairs(triples, V.LABEL, V.PREF_LABEL).select("onto_id", F.col("s").alias("p"), "o").groupBy("onto_id", "p").agg(F.collect_set("o").alias("names"))
    plain = lambda x: F.regexp_replace(F.lower(x), "[^a-z]", "")
    named = uses.join(labels, ["onto_id", "p"], "left").withColumn(
        "names", F.transform(F.concat(F.array(local_name(F.col("p"))), F.coalesce("names", F.array().cast("array<string>"))), plain)
    )
    hit = F.arrays_overlap("names", F.array(*[F.lit(n) for n in V.DEFINITION_NAMES]))
    return named.where(hit & (F.col("texts") >= 0.8 * F.col("uses"))).select("onto_id", "p", "uses")


def bp_definition_properties(triples: DataFrame, declared: DataFrame) -> DataFrame:
    """(onto_id, p, place, literal_only, source): the built-in list, then registry-declared IRIs (``declared``: onto_id, iri, at),
    then detected ones. IRIs that only point to a definition are listed with place null and the reason."""
    builtin = _ontologies(triples).select("onto_id", F.posexplode(F.array(*[F.lit(p) for p in V.DEFINITION_PROPERTIES])).alias("place", "p")).select(
        "onto_id", "p", "place", F.lit(False).alias("literal_only"), F.lit(None).cast("string").alias("source")
    )
    extra = declared.groupBy("onto_id", F.col("iri").alias("p")).agg(F.min("at").alias("at")).where(~F.col("p").isin(*V.DEFINITION_PROPERTIES))
    found = detected_definition_properties(triples)
    both = extra.join(found, ["onto_id", "p"], "full")
    ignored = F.col("at").isNotNull() & F.col("p").isin(*V.NOT_DEFINITION_TEXT)
    source = (
        F.when(ignored & F.col("uses").isNull(), "ignored: links to a defining document, not definition text")
        .when(F.col("at").isNotNull() & F.col("uses").isNotNull(), "bioportal_definitionProperty + detected_by_name")
        .when(F.col("at").isNotNull(), "bioportal_definitionProperty")
        .otherwise(F.format_string("detected_by_name (%d uses)", "uses"))
    )
    place = F.when(~(ignored & F.col("uses").isNull()), F.coalesce(F.col("at"), F.lit(1000)) + len(V.DEFINITION_PROPERTIES)).cast("int")
    return builtin.unionByName(both.select("onto_id", "p", place.alias("place"), F.lit(True).alias("literal_only"), source.alias("source")))


def entity_links(triples: DataFrame, population: DataFrame, class_set: DataFrame | None = None) -> DataFrame:
    """(onto_id, iri, p, links, restriction): links of entities by object property, from triples (each end counts) and from
    restrictions of superclasses."""
    props = materialise(G.object_properties(triples))
    members = population.select("onto_id", "iri")
    used = triples.join(props, ["onto_id", "p"], "left_semi")
    ends = used.select("onto_id", F.col("s").alias("iri"), "p").unionByName(used.select("onto_id", F.col("o").alias("iri"), "p"))
    from_triples = ends.groupBy("onto_id", "iri", "p").agg(F.count(F.lit(1)).alias("links")).join(members, KEYS, "left_semi")
    return from_triples.withColumn("restriction", F.lit(False)).unionByName(restriction_links(triples, props, class_set).withColumn("restriction", F.lit(True)))


def restriction_links(triples: DataFrame, props: DataFrame | None = None, class_set: DataFrame | None = None) -> DataFrame:
    """(onto_id, iri, p, links): classes below a restriction on an object property."""
    class_set = G.classes(triples) if class_set is None else class_set
    props = G.object_properties(triples) if props is None else props
    restrictions = G.of_type(triples, V.RESTRICTION).select("onto_id", F.col("s").alias("r"))
    on = G.pairs(triples, V.ON_PROPERTY).select("onto_id", F.col("s").alias("r"), F.col("o").alias("p"))
    on = on.join(restrictions, ["onto_id", "r"], "left_semi").join(props, ["onto_id", "p"], "left_semi")
    below = G.pairs(triples, V.SUBCLASS).select("onto_id", F.col("s").alias("iri"), F.col("o").alias("r"))
    links = on.join(below, ["onto_id", "r"]).join(class_set, KEYS, "left_semi")
    return links.groupBy("onto_id", "iri", "p").agg(F.count(F.lit(1)).alias("links"))


def connected(links: DataFrame) -> DataFrame:
    """(onto_id, iri, connection_links, connection_distinct_properties)."""
    return links.groupBy(*KEYS).agg(F.sum("links").alias("connection_links"), F.countDistinct("p").alias("connection_distinct_properties"))


def connection_score(triples: DataFrame, population: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(onto_id, connected, coverage, diversity, richness, connection_score)."""
    links = entity_links(triples, population) if links is None else links
    per_entity = connected(links)
    rich = F.least(F.log(float(V.RICHNESS_BASE), F.col("connection_links") + 1), F.lit(1.0))
    sums = per_entity.groupBy("onto_id").agg(
        F.count(F.lit(1)).alias("connected"), F.sum(F.least("connection_distinct_properties", F.lit(V.MAX_DISTINCT))).alias("kinds"),
        F.sum(F.round(rich, 12).cast("decimal(38,12)")).cast("double").alias("rich"),
    )
    n = population.groupBy("onto_id").agg(F.count(F.lit(1)).alias("entities"))
    joined = _ontologies(triples).join(n, "onto_id", "left").join(sums, "onto_id", "left").na.fill(0, ["entities", "connected", "kinds"]).na.fill(0.0, ["rich"])
    some = F.nullif(F.col("entities"), F.lit(0))
    coverage, diversity, richness = F.col("connected") / some, F.col("kinds") / float(V.MAX_DISTINCT) / some, F.col("rich") / some
    score = py_round(10.0 * (0.7 * coverage + 0.2 * diversity + 0.1 * richness))
    return joined.select(
        "onto_id", "entities", "connected",
        *[F.coalesce(c, F.lit(0.0)).alias(k) for k, c in (("coverage", coverage), ("diversity", diversity), ("richness", richness), ("connection_score", score))],
    )


def flat_score(triples: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(onto_id, max_depth, back_edges, parents, edges, roots, nodes, avg_branching, flat_score)."""
    edges = materialise(G.taxonomy(triples) if edges is None else edges)
    wide = G.breadth(edges).join(G.depths(edges), "onto_id")
    joined = _ontologies(triples).join(wide, "onto_id", "left")
    joined = joined.na.fill(0, ["max_depth", "back_edges", "parents", "edges", "roots", "nodes"]).na.fill(0.0, ["avg_branching"])
    depth = F.least(F.col("max_depth") / float(V.DEPTH_TARGET), F.lit(1.0)) * 10
    branch = F.least(F.col("avg_branching") / float(V.BRANCH_TARGET), F.lit(1.0)) * 10
    return joined.withColumn("flat_score", F.rint((depth + branch) / 2))


def averages(scores: DataFrame) -> DataFrame:
    """Adds core_average, core_average_2dp, weakest_metric, suggestions and summary_banner to the four score columns."""
    columns = [F.col(c) for c, _, _ in V.METRICS]
    mean = sum(columns[1:], columns[0]) / 4.0
    weakest = F.array_min(F.array(*[F.struct(F.col(c).alias("v"), F.lit(k).alias("k"), F.lit(name).alias("name")) for k, (c, name, _) in enumerate(V.METRICS)]))
    out = scores.withColumn("core_average", mean).withColumn("core_average_2dp", py_round(F.col("core_average"))).withColumn("_w", weakest)
    return out.withColumn("weakest_metric", F.col("_w.name")).withColumn("suggestions", suggestions()).withColumn("summary_banner", banner()).drop("_w")


def _two(x: Column) -> Column:
    return F.format_string("%.2f", py_round(x))


def suggestions(threshold: float = V.LOW_SCORE) -> Column:
    tips = [
        F.when(F.col(c) < threshold, F.concat(F.lit(f"{name} Score is low ("), _two(F.col(c)), F.lit(f"/10) because {reason}.")))
        for c, name, reason in V.METRICS
    ]
    text = F.array_join(F.array_compact(F.array(*tips)), "; ")
    return F.when(text == "", "No suggestions").otherwise(text)


def banner() -> Column:
    average, weakest, value = _two(F.col("core_average")), F.col("_w.name"), _two(F.col("_w.v"))
    # Fixed texts.
    well = F.concat(F.lit("This ontology scores well across all dimensions (average "), average, F.lit("/10). The main area to improve is "), weakest, F.lit(" ("), value, F.lit("/10)."))
    mixed = F.concat(F.lit("This ontology has mixed quality (average "), average, F.lit("/10). The weakest dimension is "), weakest, F.lit(" ("), value, F.lit("/10)."))
    low = F.concat(F.lit("This ontology scores low overall (average "), average, F.lit("/10). Several dimensions need work, starting with "), weakest, F.lit(" ("), value, F.lit("/10)."))
    return F.when(F.col("core_average") >= 8, well).when(F.col("core_average") >= 5, mixed).otherwise(low)


def language_histogram(triples: DataFrame, k: int = 20) -> DataFrame:
    texts = G.pairs(triples, *V.LABEL_PROPERTIES, *V.DEFINITION_PROPERTIES).where("o_kind = 'literal'")
    lang = F.when(F.coalesce("o_lang", F.lit("")) == "", "(none)").otherwise(F.col("o_lang"))
    return G.top_counts(G.profile_by(texts, lang, "lang"), "lang", k)


def deprecated_entities(triples: DataFrame, population: DataFrame) -> DataFrame:
    """(onto_id, iri) of entities with a true deprecation mark."""
    marks = G.pairs(triples, V.DEPRECATED).where(F.lower(stripped(F.col("o"))).isin("true", "1")).select("onto_id", F.col("s").alias("iri"))
    return population.select(*KEYS).join(marks.distinct(), KEYS, "left_semi")


def ontology_profile(triples: DataFrame, population: DataFrame) -> DataFrame:
    """The scalar statistics of each ontology, in one pass over the triples and one over the entities."""
    def typed(t: str) -> Column:
        return F.countDistinct(F.when((F.col("p") == V.TYPE) & (F.col("o") == t), F.col("s")))

    base = triples.groupBy("onto_id").agg(
        F.count(F.lit(1)).alias("triple_count"), F.countDistinct("s").alias("subjects"), F.countDistinct("p").alias("distinct_predicates"),
        typed(V.ANNOTATION).alias("annotation_properties"), typed(V.OBJECT_PROPERTY).alias("object_properties_declared"),
        typed(V.DATATYPE_PROPERTY).alias("datatype_properties_declared"), typed(V.OWL + "Class").alias("owl_classes_typed"),
        typed(V.RDFS + "Class").alias("rdfs_classes_typed"), typed(V.SKOS + "Concept").alias("skos_concepts"), typed(V.RESTRICTION).alias("owl_restrictions"),
        F.count_if(F.col("p") == V.SUBCLASS).alias("subclassof_triples"), F.count_if(F.col("p") == V.EQUIVALENT).alias("equivalentclass_triples"),
        F.countDistinct(F.when(F.col("p") == V.IMPORTS, F.col("o"))).alias("owl_imports_count"),
    )
    people = population.groupBy("onto_id").agg(
        F.count_if(F.col("kind") == "class").alias("classes"),
        F.count_if((F.col("kind") == "class") & ~F.col("iri").isin(V.THING, V.NOTHING)).alias("named_classes"),
        F.count_if(F.col("kind") == "individual").alias("individuals"), F.count(F.lit(1)).alias("entities"),
    )
    gone = deprecated_entities(triples, population).groupBy("onto_id").agg(F.count(F.lit(1)).alias("deprecated_entities"))
    return base.join(people, "onto_id", "left").join(gone, "onto_id", "left").na.fill(0)


def imports(triples: DataFrame, k: int = 200) -> DataFrame:
    listed = G.pairs(triples, V.IMPORTS).groupBy("onto_id").agg(F.array_sort(F.collect_set("o")).alias("all"))
    return listed.select("onto_id", F.size("all").alias("owl_imports_count"), F.slice("all", 1, k).alias("owl_imports"))


def identity(triples: DataFrame, hashes: DataFrame | None = None) -> DataFrame:
    """(onto_id, ontology_iri, version_iri): of the smallest ontology node; without one the file hash (onto_id, sha256)."""
    nodes = G.of_type(triples, V.ONTOLOGY)
    versions = G.pairs(triples, V.VERSION).groupBy("onto_id", "s").agg(F.min("o").alias("version"))
    first = nodes.groupBy("onto_id").agg(F.min("s").alias("s")).join(versions, ["onto_id", "s"], "left")
    base = _ontologies(triples) if hashes is None else _ontologies(triples).join(hashes, "onto_id", "left")
    short = F.lit(None).cast("string") if hashes is None else F.substring("sha256", 1, 32)
    joined = base.join(first, "onto_id", "left")
    iri = F.coalesce("s", F.concat(F.lit("file:hash:"), short), F.lit("anonymous"))
    version = F.coalesce("version", F.concat(F.lit("filehash:"), short), F.lit("filehash:unknown"))
    return joined.select("onto_id", iri.alias("ontology_iri"), version.alias("version_iri"))


def entity_table(triples: DataFrame, population: DataFrame, values: DataFrame, links: DataFrame, edges: DataFrame) -> DataFrame:
    """One row an entity with its label and all per-entity values."""
    labels = G.first_labels(triples, population).select("onto_id", F.col("s").alias("iri"), "label", "source")
    children = edges.where("NOT loop").groupBy("onto_id", F.col("parent").alias("iri")).agg(F.count(F.lit(1)).alias("children"))
    own = values.select(*KEYS, "definition_chars", "definition_word_tokens", "define_cosine", "define_match", "define_adequacy", "define_value")
    out = population.join(labels, KEYS, "left").join(described(triples, population), KEYS, "left").join(own, KEYS, "left")
    out = out.join(connected(links), KEYS, "left").join(children, KEYS, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        *KEYS, "kind", F.substring(F.coalesce("label", label_fragment(F.col("iri"))), 1, 300).alias("label"),
        F.coalesce("source", F.lit("iri_local_name")).alias("label_source"), "described", "describe_signal_count",
        F.col("define_value").isNotNull().alias("has_definition"), zero("definition_chars"), zero("definition_word_tokens"),
        "define_cosine", "define_match", "define_adequacy", F.coalesce("define_value", F.lit(0.0)).alias("define_value"),
        zero("connection_links"), zero("connection_distinct_properties"), F.coalesce("children", F.lit(0)).cast("long").alias("taxonomy_children"),
    )


def quality_band(score: Column) -> Column:
    return F.when(score >= 7, "good").when(score >= 5, "mid").when(score.isNotNull(), "low")
