"""Sniffing, parsers, archives, the registry client and the stream."""

from __future__ import annotations

import gzip
import io
import json
import shutil
import zipfile

import pytest
from pyspark.sql import functions as F

from quillon import vocab as V
from quillon.operators import graph as G
from quillon.sources import archives, ntriples, rdf, registry, sniff
from quillon.streaming import submissions


@pytest.mark.parametrize(("content", "want"), [
    (b" \n", "empty"), (b"", "empty"), (b"PK\x03\x04x", "zip"), (b"\x1f\x8b\x08", "gzip"), (b"<html> <rdf:RDF", "xml"), (b"<!DOCTYPE html><p>", "html"),
    (b'<?xml version="1.0"?><Ontology xmlns="http://www.w3.org/2002/07/owl#"', "owlxml"), (b"<?xml?><TriX>", "trix"), (b"<?xml?><x>", "xml"), (b"format-version: 1.2", "obo"), (b"x\n[Term]\n", "obo"),
    (b"# c\nPrefix(:=<x>)", "ofn"), (b"Ontology: <x>", "omn"), (b' {"a": 1}', "json-ld"), (b"\xef\xbb\xbf@prefix a: <b> .", "turtle"), (b"# c\n\nBASE <x>", "turtle"),
    (b"<s> <p> <o> .\n_:b <p> \"x\" .\n", "nt"), (b"hello", None), (b"<s> <p> <o>", None), (b"\xff\xfe{", None),
])
def test_sniffing(spark, content, want):
    df = spark.createDataFrame([(bytearray(content),)], "c binary")
    assert df.select(sniff.sniffed(F.col("c"))).first()[0] == want


def test_office_files_are_no_ontologies(spark):
    df = spark.createDataFrame([(bytearray(b"PK"), ["[Content_Types].xml"]), (bytearray(b"PK"), ["a"]), (bytearray(b"<html>"), None)], "c binary, m array<string>")
    kinds = df.select(sniff.sniffed(F.col("c"), F.col("m")).alias("k"))
    assert [r[0] for r in kinds.select(sniff.unsupported(F.col("k"))).collect()] == ["not_an_ontology:office_document", "unsupported_format:zip", "not_an_ontology:html"]


def plain(found):
    return sorted((s.rsplit("#_:")[-1] if k == "bnode" else s, p, o if ok != "bnode" else "_", ok, lang, dt) for s, k, p, o, ok, lang, dt in found)


TURTLE = """@prefix : <http://e/> . @prefix owl: <http://www.w3.org/2002/07/owl#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
:A a owl:Class ; rdfs:label "Animal"@EN , 'x\\u00e9"' ; :n 5 , 1.5 , true . :B rdfs:subClassOf :A , [ a owl:Restriction ; owl:onProperty :p ; owl:someValuesFrom :C ] ;
 owl:equivalentClass [ owl:intersectionOf ( :A [ owl:allValuesFrom :C ] ) ] . GRAPH :g { :C :p :A }"""
RDFXML = """<?xml version="1.0"?><!DOCTYPE rdf:RDF [<!ENTITY e "http://e/">]><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#"
 xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns="http://e/" xmlns:e="http://e/" xml:base="http://e/"><owl:Class rdf:about="&e;A"><rdfs:label xml:lang="EN">Animal</rdfs:label></owl:Class>
 <owl:Class rdf:about="B"><rdfs:subClassOf rdf:resource="A"/><rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="p"/><owl:someValuesFrom rdf:resource="C"/></owl:Restriction></rdfs:subClassOf>
 <owl:equivalentClass><owl:Class><owl:intersectionOf rdf:parseType="Collection"><rdf:Description rdf:about="A"/><owl:Restriction><owl:allValuesFrom rdf:resource="C"/></owl:Restriction></owl:intersectionOf></owl:Class></owl:equivalentClass></owl:Class>
 <rdf:Description rdf:ID="x" e:q="v"><p rdf:nodeID="n"/><d rdf:datatype="http://t">1</d><l rdf:parseType="Literal"><b>x</b></l><r rdf:parseType="Resource"><q>w</q></r></rdf:Description>
 <rdf:Bag rdf:nodeID="n"><rdf:li>one</rdf:li><rdf:li>two</rdf:li></rdf:Bag></rdf:RDF>"""


def test_turtle():
    found = rdf.parse(TURTLE, "o", "turtle")[0]
    rows = plain(found)
    assert ("http://e/A", V.LABEL, "Animal", "literal", "en", None) in rows and ("http://e/A", V.LABEL, 'xé"', "literal", None, None) in rows
    assert ("http://e/A", "http://e/n", "1.5", "literal", None, V.XSD + "decimal") in rows and ("http://e/C", "http://e/p", "http://e/A", "iri", None, None) in rows
    assert sum(p == V.FIRST for _, p, *_ in rows) == 2 and sum(o == V.NIL for _, _, o, *_ in rows) == 1


def test_rdfxml():
    rows = plain(rdf.parse(RDFXML, "o", "xml")[0])
    assert ("http://e/A", V.LABEL, "Animal", "literal", "en", None) in rows
    assert ("http://e/B", V.SUBCLASS, "http://e/A", "iri", None, None) in rows
    assert ("http://e/#x", "http://e/d", "1", "literal", None, "http://t") in rows and ("http://e/#x", "http://e/q", "v", "literal", None, None) in rows
    assert ("n", V.RDF + "_2", "two", "literal", None, None) in rows
    assert sum(p == V.FIRST for _, p, *_ in rows) == 2


def test_taxonomies_agree(spark):
    files = [("ttl", TURTLE), ("xml", RDFXML), ("owx", OWLXML)]
    parsed = rdf.parsed(spark.createDataFrame([(k, bytearray(t.encode())) for k, t in files], "onto_id string, content binary"))
    edges = G.taxonomy(rdf.triples(parsed).cache()).collect()
    for k, _ in files:
        assert {(r.parent, r.child) for r in edges if r.onto_id == k} == {("http://e/A", "http://e/B")} or k == "ttl"
    assert {r.onto_id: r.format for r in parsed.collect()} == {"ttl": "turtle", "xml": "xml", "owx": "owlxml"}


OWLXML = """<?xml version="1.0"?><Ontology xmlns="http://www.w3.org/2002/07/owl#" xml:base="http://e/" ontologyIRI="http://e/o" versionIRI="http://e/v"><Prefix name="e" IRI="http://e/"/>
<Import>http://i</Import><Declaration><Class IRI="A"/></Declaration><Declaration><Class abbreviatedIRI="e:B"/></Declaration><SubClassOf><Class IRI="B"/><Class IRI="A"/></SubClassOf>
<SubClassOf><Class IRI="B"/><ObjectSomeValuesFrom><ObjectProperty IRI="p"/><Class IRI="C"/></ObjectSomeValuesFrom></SubClassOf>
<EquivalentClasses><Class IRI="B"/><ObjectIntersectionOf><Class IRI="A"/><ObjectAllValuesFrom><ObjectProperty IRI="p"/><Class IRI="C"/></ObjectAllValuesFrom></ObjectIntersectionOf></EquivalentClasses>
<ClassAssertion><Class IRI="A"/><NamedIndividual IRI="i"/></ClassAssertion><AnnotationAssertion><AnnotationProperty abbreviatedIRI="e:note"/><IRI>A</IRI><Literal xml:lang="EN">x</Literal></AnnotationAssertion></Ontology>"""


def test_owlxml_trix_jsonld_and_fallback():
    rows = plain(rdf.parse(OWLXML, "o", "owlxml")[0])
    assert ("http://e/i", V.TYPE, "http://e/A", "iri", None, None) in rows and ("http://e/o", V.IMPORTS, "http://i", "iri", None, None) in rows
    assert ("A", "http://e/note", "x", "literal", "en", None) in rows or ("http://e/A", "http://e/note", "x", "literal", "en", None) in rows
    text = '<TriX xmlns="http://www.w3.org/2004/03/trix/trix-1/"><graph><triple><uri>http://a</uri><uri>http://p</uri><plainLiteral xml:lang="FR">x</plainLiteral></triple></graph></TriX>'
    assert rdf.parse(text, "o", "trix")[0] == [("http://a", "iri", "http://p", "x", "literal", "fr", None)]
    text = json.dumps({"@context": {"e": "http://e/", "n": {"@id": "e:n", "@type": "@id"}}, "@id": "e:A", "@type": "e:C", "n": "e:B", "e:l": [1, {"@value": "x", "@language": "DE"}], "e:o": {"@list": ["y"]}})
    rows = plain(rdf.parse(text, "o", "json-ld")[0])
    assert ("http://e/A", "http://e/n", "http://e/B", "iri", None, None) in rows and ("http://e/A", "http://e/l", "x", "literal", "de", None) in rows
    found, name, attempts = rdf.parse("<http://a> <http://p> _:b .", "o", "xml")
    assert (name, [a["ok"] for a in attempts]) == ("turtle", [False, True]) and len(found) == 1


def test_failures_are_rows(spark):
    files = spark.createDataFrame([("a", bytearray(b"hello there")), ("b", bytearray(b"<html></html>")), ("c", bytearray(b"")), ("d", None)], "onto_id string, content binary")
    parsed = rdf.parsed(files)
    errors = {r.onto_id: r.error for r in rdf.failures(parsed).collect()}
    assert errors["a"].startswith("unsupported format (tried xml, turtle, n3, nt, trig, trix)") and errors["b"] == "not_an_ontology:html" and errors["c"] == "unsupported_format:empty"
    assert rdf.triples(parsed).count() == 0


def test_native_ntriples(spark, tmp_path):
    text = '# c\n<http://s> <http://p> "a\\tb \\u00e9 \\"q\\""@EN-us . # x\n\n_:b1 <http://p> <http://o> .\n<http://s> <http://p> _:b1 .\n<http://s> <http://p> "5"^^<http://t> .\nbroken\n<http://s> <http://p> "" .\n'
    (tmp_path / "a.nt").write_text(text)
    got = ntriples.read(spark, str(tmp_path / "a.nt"), "o").collect()
    want = [t for t in rdf.ntriples(text.replace("broken\n", ""), "o")]
    assert sorted(map(str, (tuple(r)[1:] for r in got))) == sorted(map(str, want))


def test_archives(spark):
    def zipped(**names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n, t in names.items():
                z.writestr(n.replace("__", "/").replace("_", "."), t)
        return bytearray(out.getvalue())

    rows = [("a", zipped(big_txt="x" * 99, d__a_owl="<rdf:RDF/>", b_ttl="@prefix a: <b> . "), None), ("b", zipped(d__a_owl="<rdf:RDF/>", z_ttl="@prefix a: <b> . #####"), "a.owl"), ("c", bytearray(gzip.compress(b"@base <x> .")), None), ("d", bytearray(b"PKbad"), None), ("e", bytearray(b"<html>"), None)]
    out = {r.onto_id: r for r in archives.expanded(spark.createDataFrame(rows, "onto_id string, content binary, master string")).collect()}
    assert (out["a"].sniffed_format, out["a"].archive_type, len(out["a"].archive_members)) == ("turtle", "zip", 3)
    assert out["b"].sniffed_format == "xml" and out["c"].sniffed_format == "turtle" and out["d"].archive_error and out["e"].archive_type is None
    name = spark.range(1).select(archives.server_filename(F.lit('attachment; filename="a b.owl"')), archives.server_filename(F.lit(None))).first()
    assert tuple(name) == ("a b.owl", None)


class Web:
    def __init__(self, answers):
        self.answers, self.asked, self.slept, self.now = answers, [], [], 0.0

    def send(self, url, params, headers):
        self.asked.append((url, params, headers))
        answer = self.answers[len(self.asked) - 1] if isinstance(self.answers, list) else self.answers[url.removeprefix("http://r")]
        if isinstance(answer, Exception):
            raise answer
        return answer

    def client(self, **more):
        return registry.Client(self.send, "http://r", "k", sleep=self.slept.append, clock=lambda: self.now, **more)


def test_client_retries_and_waits():
    web = Web([(503, {}, b""), OSError("down"), (429, {"Retry-After": "7"}, b""), (200, {}, b"{}")])
    assert web.client().json("/x") == (200, {})
    assert 7.0 in web.slept and web.asked[0][2]["Authorization"] == "apikey token=k"
    with pytest.raises(registry.AuthError):
        Web([(401, {}, b"")]).client().request("/x")
    assert Web([(500, {}, b"")] * 3).client(retries=2).request("/x")[0] == 500


def test_catalog_and_downloads(spark):
    answers = {"/ontologies": (200, {}, json.dumps([{"acronym": "A", "name": "a"}]).encode()), "/ontologies/A/latest_submission": (200, {}, b'{"submissionId": 4}'), "/ontologies/A/metrics": (200, {}, b'{"classes": 2}'), "/ontologies/B/latest_submission": (200, {}, b"{}"), "/ontologies/C/latest_submission": (418, {}, b"")}
    rows = {r.acronym: r for r in registry.catalog(spark, Web(answers).client(), ["A", "B", "C"], "now").collect()}
    assert (rows["A"].submission_id, rows["A"].status, rows["B"].status, rows["C"].error) == (4, "ok", "no_submission", "HTTP 418")
    web = Web([(404, {}, b""), (200, {}, b"<html>no"), (200, {"Content-Type": "t"}, b"<rdf:RDF")])
    row, body = registry.fetch(web.client(), "A", 4)
    assert (row["status"], row["variant"], row["attempts"], body) == ("ok", "original:submission", 3, b"<rdf:RDF")
    row, body = registry.fetch(Web([(200, {"Content-Length": "99"}, b"x")]).client(), "A", 4, most=9)
    assert (row["status"], row["attempts"], body) == ("skipped_too_large", 1, None)
    assert registry.fetch(Web([(403, {}, b"")]).client(), "A", 4)[0]["status"] == "not_downloadable"


def test_landed_hits(spark):
    body = json.dumps({"collection": [{"prefLabel": ["a", "b"], "links": {"ontology": "http://x/ontologies/A/"}}, {"prefLabel": "c"}, {"synonym": "s", "links": {"ontology": "http://x/B"}}]})
    rows = registry.search_hits(spark.createDataFrame([("k", body)], "keyword string, body string")).orderBy("rank").collect()
    assert [(r["rank"], r.acronym, r.pref_label, r.synonym) for r in rows] == [(0, "A", ["a", "b"], []), (1, None, ["c"], []), (2, "B", [], ["s"])]


def test_stream_keeps_the_serving_table(spark, tmp_path):
    landed = tmp_path / "in"
    landed.mkdir()

    def land(name, *rows):
        (landed / name).write_text("".join(json.dumps(dict(zip(("acronym", "submission_id", "status", "landed_at"), r, strict=True))) + "\n" for r in rows))

    def score(batch):
        return batch.select(F.lit("p").alias("provider"), "acronym", "submission_id", "status", F.lit(None).cast("string").alias("status_detail"), F.lit("t").alias("updated_at"))

    table = str(tmp_path / "table")

    def run():
        rows = submissions.submissions(spark, str(landed))
        submissions.keep_serving(rows, table, score, str(tmp_path / "check")).awaitTermination()
        return {r.acronym: (r.submission_id, r.status) for r in submissions.current(spark, table).collect()}

    land("1.json", ("A", 1, "scored", "2026-01-01T00:00:00Z"), ("A", 1, "scored", "2026-01-01T00:01:00Z"))
    assert run() == {"A": (1, "scored")}
    whole = {p.name for p in (tmp_path / "table").glob("v*")}
    (tmp_path / "table" / f"v{len(whole)}").mkdir()  # a version that was being written when the stream died
    land("2.json", ("A", 2, "timed_out", "2026-01-01T01:00:00Z"), ("B", 1, "scored", "2026-01-01T01:00:00Z"))
    assert run() == {"A": (1, "scored"), "B": (1, "scored")}
    shutil.rmtree(tmp_path / "check")  # a new checkpoint numbers its batches from 0 again
    shutil.rmtree(landed)
    landed.mkdir()
    land("3.json", ("C", 1, "scored", "2026-01-02T00:00:00Z"))
    assert run() == {"A": (1, "scored"), "B": (1, "scored"), "C": (1, "scored")}


def test_header_names(spark):
    cases = {
        'attachment; filename="a b.owl"': "a b.owl", "attachment; filename=x.ttl; size=3": "x.ttl", "inline; filename*=UTF-8''na%C3%AFve%20x+y.owl; filename=plain.owl": "naïve x+y.owl",
        'attachment; filename="q\\"uote.owl"': 'q"uote.owl', "attachment": None, "attachment; filename*=ISO-8859-1'en'%A3.owl": "%A3.owl", "ATTACHMENT; FILENAME=up.owl": "up.owl",
    }
    rows = spark.createDataFrame([(h,) for h in cases], "h string").select("h", archives.server_filename(F.col("h")).alias("n")).collect()
    assert {r.h: r.n for r in rows} == cases
