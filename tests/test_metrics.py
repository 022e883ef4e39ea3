"""Graph operators and scores against values worked out by hand."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillon import schemas
from quillon import vocab as V
from quillon.functions.encoder import batched, hashing
from quillon.functions.stats import column_profile, distribution
from quillon.functions.text import adequacy, cosine, local_name, py_round, tokens
from quillon.operators import graph as G
from quillon.operators import metrics as M
from quillon.plans.scoring import summary

E = "http://e/"
CLASS = V.OWL + "Class"


def triple(onto, s, p, o, lang=None):
    kind = lambda x: "bnode" if x.startswith("_:") else "iri"
    if o.startswith('"'):
        return (onto, s if s.startswith("_:") else E + s, kind(s), p, o.strip('"'), "literal", lang, None)
    full = lambda x: x if x.startswith(("_:", "http")) else E + x
    return (onto, full(s), kind(s), p, full(o), kind(o), None, None)


MINI = [
    *[("mini", c, V.TYPE, CLASS) for c in "ABCD"],
    ("mini", "B", V.SUBCLASS, "A"), ("mini", "C", V.SUBCLASS, "A"), ("mini", "D", V.SUBCLASS, "B"), ("mini", "D", V.SUBCLASS, "_:r"),
    ("mini", "_:r", V.TYPE, V.RESTRICTION), ("mini", "_:r", V.ON_PROPERTY, "p"), ("mini", "_:r", V.OWL + "someValuesFrom", "C"),
    ("mini", "p", V.TYPE, V.OBJECT_PROPERTY), ("mini", "A", E + "p", "B"), ("mini", "i1", V.TYPE, "C"),
    ("mini", "A", V.LABEL, '"Animal"'), ("mini", "B", V.LABEL, '"Bird"'), ("mini", "D", V.PREF_LABEL, '"Duck"'),
    ("mini", "A", V.COMMENT, '"An animal is a living thing that moves"'), ("mini", "B", V.COMMENT, '"Bird"'),
    ("mini", "i1", V.XL_ALT_LABEL, "x1"), ("mini", "x1", V.XL_FORM, '"one"'),
]
MORE = [
    ("empty", "a", E + "q", "b"),
    *[("no_defs", c, V.TYPE, CLASS) for c in "AB"], ("no_defs", "A", V.LABEL, '"A"'),
    ("one_def", "A", V.TYPE, CLASS), ("one_def", "A", V.COMMENT, '"some text"'),
    ("self_loop", "A", V.SUBCLASS, "A"),
    ("cycle", "A", V.SUBCLASS, "B"), ("cycle", "B", V.SUBCLASS, "C"), ("cycle", "C", V.SUBCLASS, "A"),
    *[("list", c, V.TYPE, CLASS) for c in "BCD"], ("list", "D", V.EQUIVALENT, "_:e"), ("list", "_:e", V.INTERSECTION, "_:l1"),
    ("list", "_:l1", V.FIRST, "B"), ("list", "_:l1", V.REST, "_:l2"), ("list", "_:l2", V.FIRST, "_:x"), ("list", "_:l2", V.REST, V.NIL), ("list", "_:x", V.OWL + "someValuesFrom", "C"),
    *[("bad_list", c, V.TYPE, CLASS) for c in "BD"], ("bad_list", "D", V.EQUIVALENT, "_:e"), ("bad_list", "_:e", V.INTERSECTION, "_:l1"),
    ("bad_list", "_:l1", V.FIRST, "B"), ("bad_list", "_:l1", V.REST, "_:l2"), ("bad_list", "_:l2", V.REST, "_:l1"),
    ("bnode", "A", V.TYPE, CLASS), ("bnode", "_:i", V.TYPE, "A"),
    ("thing", "A", V.SUBCLASS, V.THING),
    *[("skos", c, V.TYPE, V.SKOS + "Concept") for c in "AB"], ("skos", "A", V.SKOS + "broader", "B"),
    *[("own", f"c{k}", V.TYPE, CLASS) for k in range(10)], *[("own", f"c{k}", E + "P97", f'"text number {k}"') for k in range(10)], ("own", "P97", V.LABEL, '"DEFINITION"'),
    ("multi", "A", V.TYPE, CLASS), ("multi", "A", V.LABEL, '"aaa"'), ("multi", "A", V.PREF_LABEL, '"zz"'), ("multi", "A", V.PREF_LABEL, '"yy"'),
]


@pytest.fixture(scope="module")
def triples(spark):
    return spark.createDataFrame([triple(*t) for t in MINI + MORE], schemas.TRIPLES).cache()


@pytest.fixture(scope="module")
def people(triples):
    return G.entities(triples).cache()


def by_onto(df):
    return {r.onto_id: r for r in df.collect()}


def test_populations(people):
    rows = {(r.onto_id, r.kind): r.n for r in people.groupBy("onto_id", "kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert rows["mini", "class"] == 4 and rows["mini", "individual"] == 1
    assert rows["bnode", "individual"] == 1
    assert rows["thing", "class"] == 2
    assert ("empty", "class") not in rows


def test_describe(triples, people):
    rows = by_onto(M.describe_score(triples, people))
    assert (rows["mini"].described, rows["mini"].by_xl, rows["mini"].describe_score) == (4, 1, 8.0)
    assert rows["empty"].describe_score == 0.0
    assert rows["no_defs"].describe_score == 5.0


def test_connection(triples, people):
    assert {r.p for r in G.object_properties(triples).where("onto_id = 'mini'").collect()} == {E + "p", V.XL_ALT_LABEL}
    row = by_onto(M.connection_score(triples, people))["mini"]
    assert (row.coverage, row.diversity) == (pytest.approx(0.8), pytest.approx(0.16))
    assert row.richness == pytest.approx(0.2312519, abs=1e-6)
    assert row.connection_score == 6.15
    links = {r.iri: (r.connection_links, r.connection_distinct_properties) for r in M.connected(M.entity_links(triples, people)).where("onto_id = 'mini'").collect()}
    assert links == {E + "A": (1, 1), E + "B": (1, 1), E + "D": (1, 1), E + "i1": (1, 1)}
    assert by_onto(M.connection_score(triples, people))["skos"].connected == 2


def test_taxonomy_and_flat(triples):
    edges = G.taxonomy(triples)
    of = lambda o: {(r.parent[-1], r.child[-1]) for r in edges.where(F.col("onto_id") == o).collect()}
    assert of("mini") == {("A", "B"), ("A", "C"), ("B", "D"), ("C", "D")}
    assert of("list") == {("B", "D"), ("C", "D")}
    assert of("bad_list") == {("B", "D")}
    assert of("thing") == of("skos") == set()
    rows = by_onto(M.flat_score(triples))
    assert (rows["mini"].max_depth, rows["mini"].avg_branching, rows["mini"].flat_score) == (3, pytest.approx(4 / 3), 5)
    assert (rows["self_loop"].parents, rows["self_loop"].edges, rows["self_loop"].max_depth, rows["self_loop"].flat_score) == (1, 0, 1, 1)
    assert (rows["empty"].max_depth, rows["empty"].flat_score) == (0, 0)
    assert rows["cycle"].back_edges >= 1 and rows["cycle"].max_depth == 4
    assert rows["skos"].flat_score == 0


def test_depth_of_random_hierarchies(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    for o in range(6):
        n = 60
        edges = {(a, b) for a, b in ((rnd.randint(0, n), rnd.randint(0, n)) for _ in range(70)) if a < b}
        depth = {}
        for a in range(n, -1, -1):
            depth[a] = 1 + max((depth[b] for x, b in edges if x == a), default=0)
        want[str(o)] = max(depth[a] for a, _ in edges)
        rows += [(str(o), f"{a:03}", f"{b:03}", False) for a, b in edges]
    got = G.depths(spark.createDataFrame(rows, "onto_id string, parent string, child string, loop boolean")).collect()
    assert {r.onto_id: (r.max_depth, r.back_edges) for r in got} == {k: (v, 0) for k, v in want.items()}
    walked = {k: G._longest_path([(r[1], r[2]) for r in rows if r[0] == k], {r[1] for r in rows if r[0] == k}) for k in want}
    assert walked == {k: (v, 0) for k, v in want.items()}


def test_depths_of_cycles_and_of_what_lies_below(spark):
    rnd = random.Random(9)
    rows = []
    for o in range(5):
        edges = {(a, b) for a, b in ((rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(45)) if a != b}
        rows += [(str(o), f"{a:03}", f"{b:03}", False) for a, b in edges] + [(str(o), "050", "051", False), (str(o), "052", "052", True)]
    table = spark.createDataFrame(rows, "onto_id string, parent string, child string, loop boolean")
    want = {k: G._longest_path([(r[1], r[2]) for r in rows if r[0] == k and not r[3]], {r[1] for r in rows if r[0] == k}) for k in "01234"}
    assert any(cut for _, cut in want.values())
    assert {r.onto_id: (r.max_depth, r.back_edges) for r in G.depths(table).collect()} == want


@pytest.mark.parametrize("walked_edges", [0, 1000])
def test_depths_without_a_level_limit(spark, walked_edges):
    chain = [("c", f"{k:02}", f"{k + 1:02}", False) for k in range(11)] + [("d", "a", "b", False)]
    table = spark.createDataFrame(chain, "onto_id string, parent string, child string, loop boolean")
    assert {r.onto_id: r.max_depth for r in G.depths(table, rounds=4, walked_edges=walked_edges).collect()} == {"c": 12, "d": 2}


def test_long_cyclic_and_shared_lists(spark):
    def cell(k, item, rest):
        return [("o", k, "bnode", V.FIRST, item, "literal", None, None), ("o", k, "bnode", V.REST, rest, "bnode", None, None)]

    n, rows = 5000, []
    for k in range(n):
        rows += cell(f"c{k}", f"i{k}", f"c{k + 1}" if k + 1 < n else V.NIL)
    rows += cell("x0", "a", "x1") + cell("x1", "b", "x2") + cell("x2", "c", "x1") + cell("y0", "first", f"c{n - 2}")
    heads = spark.createDataFrame([("o", h) for h in ("c0", "x0", "y0", V.NIL, "none")], "onto_id string, head string")
    got = {}
    for r in G.list_items(spark.createDataFrame(rows, schemas.TRIPLES), heads).collect():
        got.setdefault(r["head"], []).append((r.position, r["item"]))
    assert sorted(got["c0"]) == [(k, f"i{k}") for k in range(n)]
    assert sorted(got["x0"]) == [(0, "a"), (1, "b"), (2, "c")]
    assert sorted(got["y0"]) == [(0, "first"), (1, f"i{n - 2}"), (2, f"i{n - 1}")]
    assert set(got) == {"c0", "x0", "y0"}


def test_source_counts(triples, people):
    values = people.select("onto_id", "iri").limit(0)
    assert M.definition_sources(triples, values).isEmpty() and M.label_sources(triples, values).isEmpty()
    named = M.label_sources(triples, people).groupBy("onto_id").agg(F.sum("n").alias("n"))
    assert {r.onto_id: r.n for r in named.collect()} == {r.onto_id: r["count"] for r in people.groupBy("onto_id").count().collect()}
    for r in M.counted(M.label_sources(triples, people), "source", 2).collect():
        assert 1 <= len(r.counts) <= 2 and list(r.counts.values()) == sorted(r.counts.values(), reverse=True)


def test_cut_counts(triples, spark):
    texts = spark.createDataFrame([("o", "http://e/a", "one two"), ("o", "http://e/b", "w " * 40)], "onto_id string, iri string, definition string")
    (row,) = M.cut_counts(triples, texts, lambda x: F.size(F.split(x, " ")), most=30).collect()
    assert (row.short, row.cut_definitions, row.cut_labels) == (1, 1, 0)


@pytest.mark.parametrize("x", [0.0, -0.0, 1.0, -2.5, 0.1, 1e-3, 1.5e-3, 1e-4, 1.25e-4, 1e-5, 1.5e-7, 1e7, 12345678.9, 1e15, 1.2345678901234567e15, 1e16, 1.5e300, 2.5e-300, 123456789012345680.0, 1 / 3, float("inf")])
def test_python_floats(spark, x):
    from quillon.functions.text import python_float

    assert spark.createDataFrame([(x,)], "x double").select(python_float(F.col("x"))).first()[0] == repr(x)


def test_list_walk(triples):
    heads = G.pairs(triples, V.INTERSECTION).select("onto_id", F.col("o").alias("head"))
    rows = sorted((r.onto_id, r.position, r["item"]) for r in G.list_items(triples, heads).collect())
    assert rows == [("bad_list", 0, E + "B"), ("list", 0, E + "B"), ("list", 1, "_:x")]


def test_define(triples, people, spark):
    cosines = spark.createDataFrame([("mini", E + "A", 0.8), ("mini", E + "B", 0.6), ("one_def", E + "A", 0.3)], "onto_id string, iri string, define_cosine double")
    values = M.defined(M.definition_texts(triples, people).join(cosines, ["onto_id", "iri"]))
    row = {(r.onto_id, r.iri): r for r in values.collect()}
    a, b = row["mini", E + "A"], row["mini", E + "B"]
    assert (a.define_adequacy, b.define_adequacy) == (pytest.approx(0.566667, abs=1e-6), pytest.approx(0.633333, abs=1e-6))
    assert (a.define_match, b.define_match) == (pytest.approx(0.731059, abs=1e-6), pytest.approx(0.268941, abs=1e-6))
    assert (a.define_value, b.define_value) == (pytest.approx(0.632423, abs=1e-6), pytest.approx(0.487577, abs=1e-6))
    assert row["one_def", E + "A"].define_match == 0.5
    scores = by_onto(M.define_score(triples, people, values))
    assert scores["mini"].define_score == 2.24
    assert scores["no_defs"].define_score == 0.0 and scores["no_defs"].cosine_mean is None


def test_definition_properties(triples, spark):
    found = M.detected_definition_properties(triples).collect()
    assert [(r.onto_id, r.p, r.uses) for r in found] == [("own", E + "P97", 10)]
    declared = spark.createDataFrame([("mini", V.RDFS + "isDefinedBy", 0), ("mini", E + "def", 1), ("own", E + "P97", 0)], "onto_id string, iri string, at int")
    rows = {(r.onto_id, r.p): r for r in M.bp_definition_properties(triples, declared).where("literal_only").collect()}
    assert rows["mini", V.RDFS + "isDefinedBy"].place is None and rows["mini", V.RDFS + "isDefinedBy"].source.startswith("ignored")
    assert rows["mini", E + "def"].source == "bioportal_definitionProperty"
    assert rows["own", E + "P97"].source.endswith("detected_by_name")


def test_summary_of_all(triples):
    rows = by_onto(summary(triples))
    assert rows["own"].define_score == 0.0 < rows["own"].define_bp_score
    assert rows["own"].define_bp_source == f"{E}P97: detected_by_name (10 uses)"
    assert rows["mini"].define_bp_source == "same_as_strict" and rows["mini"].define_bp_score == rows["mini"].define_score
    assert rows["empty"].empty_ontology and rows["empty"].core_average == 0.0
    assert (rows["mini"].ontology_iri, rows["mini"].version_iri) == ("anonymous", "filehash:unknown")
    for r in rows.values():
        assert all(0 <= r[c] <= 10 for c, _, _ in V.METRICS)


def test_averages_and_texts(spark):
    df = spark.createDataFrame([("a", 8.0, 2.24, 6.15, 5.0), ("b", 9.0, 9.0, 9.0, 9.0), ("c", 1.0, 1.0, 2.0, 3.0)], "onto_id string, describe_score double, define_score double, connection_score double, flat_score double")
    rows = by_onto(M.averages(df))
    assert rows["a"].core_average == pytest.approx(5.3475) and rows["a"].weakest_metric == "Define"
    assert rows["a"].suggestions == "Define Score is low (2.24/10) because the annotations lack semantic meaning."
    assert rows["a"].summary_banner.startswith("This ontology has mixed quality (average 5.35/10).")
    assert rows["b"].suggestions == "No suggestions" and rows["b"].weakest_metric == "Describe"
    assert rows["b"].summary_banner.startswith("This ontology scores well")
    assert rows["c"].summary_banner.endswith("starting with Describe (1.00/10).")


def test_first_label(triples):
    row = [r for r in G.first_labels(triples).where("onto_id = 'multi'").collect()][0]
    assert (row.label, row.source) == ("yy", "skos:prefLabel")


def test_partitions_do_not_change_scores(triples):
    a = sorted(map(str, summary(triples).collect()))
    assert a == sorted(map(str, summary(triples.repartition(7)).collect()))


def test_python_rounding(spark):
    rnd = random.Random(9)
    values = [2.675, 1.005, 0.125, 0.375, 2.5, -2.675, -0.125, 0.0, 1e-9, 123456.785] + [rnd.uniform(-50, 50) for _ in range(3000)] + [k / 8 for k in range(-200, 200)] + [k / 1000 + 0.005 for k in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", py_round(F.col("x")).alias("r"), py_round(F.col("x"), 4).alias("q")).collect()
    assert all(r.r == round(r.x, 2) and r.q == round(r.x, 4) for r in rows)


def test_tokens_and_adequacy(spark):
    texts = ["éx ab", "", "...", "The THE the", " ".join(["word"] * 20)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(tokens(F.col("t")).alias("w"), adequacy(tokens(F.col("t"))).alias("a")).collect()
    assert [len(r.w) for r in rows] == [3, 0, 0, 3, 20]
    assert [r.a for r in rows] == [pytest.approx(0.1 + 0.6), 0.0, 0.0, pytest.approx(0.1), 1.0]


def test_names_and_vectors(spark):
    row = spark.range(1).select(
        local_name(F.lit("http://a/b#c/d")).alias("n"), cosine(F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(3.0))).alias("c"),
        cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("z"), hashing(F.lit("two words")).alias("h"), batched(lambda texts: [[float(len(t))] for t in texts])(F.lit("abc")).alias("b"),
    ).first()
    assert row.n == "c/d" and row.c == pytest.approx(0.96) and row.z is None
    assert len(row.h) == 64 and sum(abs(x) for x in row.h) in (0.0, 2.0) and row.b == [3.0]


def test_distribution_and_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (float("nan"), "b"), (None, "c")], "x double, y string")
    d = df.where("x < 10").select(distribution(F.col("x")).alias("d")).first().d
    assert (d.n, d.mean, d.std, d.median, d.p25) == (2, 1.5, 0.5, 1.5, 1.25)
    assert {(r["column"], r.dtype, r.non_null) for r in column_profile(df).collect()} == {("x", "double", 2), ("y", "string", 3)}
