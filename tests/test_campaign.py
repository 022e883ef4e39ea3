"""A campaign from files to a serving table."""

from __future__ import annotations

import gzip
import json

from pyspark.sql import functions as F

from quillon import schemas
from quillon.plans import campaign as C

GOOD = b"""@prefix : <http://e/> . @prefix owl: <http://www.w3.org/2002/07/owl#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .
:A a owl:Class ; rdfs:label "a" ; rdfs:comment "a thing" . :B a owl:Class ; rdfs:subClassOf :A ."""
FILES = "acronym string, submission_id long, content binary, master string"


def files(spark, **contents):
    return spark.createDataFrame([(k, 1, bytearray(v), None) for k, v in contents.items()], FILES)


def test_evaluate(spark):
    rows = {r.acronym: r for r in C.evaluate(files(spark, a=GOOD, b=gzip.compress(GOOD), c=b"<html>", d=b"hello", e=b"# nothing\n@prefix a: <b> ."), F.lit("now"), "r1").collect()}
    assert rows["a"].status == rows["b"].status == "done" and rows["a"].describe_score == rows["b"].describe_score == 5.0
    assert (rows["c"].status, rows["c"].error, rows["c"].describe_score) == ("parse_failed", "not_an_ontology:html", None)
    assert rows["d"].status == "parse_failed" and rows["d"].error_type == "ParseError"
    assert rows["e"].status == "done" and '"entities":0' in rows["e"].summary_json and rows["e"].core_average == 0.0
    assert '"classes":2' in rows["a"].summary_json


def test_submissions_of_one_acronym_stay_apart(spark):
    two = spark.createDataFrame([("a", 1, bytearray(GOOD), None), ("a", 2, bytearray(GOOD.replace(b":B a owl:Class ;", b":B a owl:Class . :C a owl:Class . :B")), None)], FILES)
    rows = {r.submission_id: r for r in C.evaluate(two, F.lit("now"), "r1").collect()}
    assert '"classes":2' in rows[1].summary_json and '"classes":3' in rows[2].summary_json


def test_queue_and_repair(spark):
    downloads = spark.createDataFrame([{"acronym": a, "submission_id": 1, "status": "ok", "eval_bytes": n, "variant": "rdf:latest"} for a, n in (("a", 2), ("b", 1), ("c", 3))], schemas.DOWNLOADS)
    before = spark.createDataFrame([{"acronym": "c", "submission_id": 1, "status": "crashed", "attempts": 2}], schemas.EVALUATIONS)
    after = C.run_queue(downloads, before, files(spark, a=GOOD, b=b"bad", c=GOOD), F.lit("t"), "r").cache()
    assert {r.acronym: (r.status, r.attempts) for r in after.collect()} == {"a": ("done", 1), "b": ("parse_failed", 1), "c": ("gave_up", 2)}
    only = C.run_queue(downloads, before.limit(0), files(spark, a=GOOD, b=GOOD, c=GOOD), F.lit("t"), "r", limit=1)
    assert [r.acronym for r in only.collect()] == ["b"]
    catalog = spark.createDataFrame([{"acronym": a, "submission_json": "{}"} for a in "abc"], schemas.CATALOG)
    asked = []

    def fetch(places):
        asked.extend((r.acronym, r.variant) for r in places.collect())
        return files(spark, b=GOOD)

    fixed = C.repair(downloads, after, catalog, files(spark, b=b"still bad"), F.lit("t"), "r", fetch)
    assert {r.acronym: r.status for r in fixed.collect()} == {"a": "done", "b": "done", "c": "gave_up"}
    assert asked == [("b", "original:submission")]


def test_entities_parity_and_report(spark, tmp_path):
    table = spark.createDataFrame([("o", f"i{k}", k) for k in range(5)] + [("p", "x", 1)], "onto_id string, iri string, n int")
    C.write_entities(table, str(tmp_path / "e"), most=2)
    back = spark.read.option("header", "true").csv(str(tmp_path / "e"))
    assert sorted((r.onto_id, r.iri) for r in back.collect()) == [("o", "i0"), ("o", "i1"), ("p", "x")]
    kind = "onto_id string, describe_score double, define_score double, connection_score double, flat_score double"
    got = spark.createDataFrame([("o", 1.0, 2.0, 3.0, 4.0)], kind)
    want = spark.createDataFrame([("o", 1.0, 2.0, 3.5, 4.0)], kind)
    assert [tuple(r) for r in C.parity(got, want).collect()] == [("o", "connection_score", 3.0, 3.5)] and C.parity(got, got).isEmpty()
    report = C.session_report(spark)
    assert report["spark"] == spark.version and report["conf"]


def made_up_registry():
    """What makes a task's client of a made-up registry."""
    from quillon.sources import registry

    good, packed = GOOD, gzip.compress(GOOD)
    def send(url, params, headers):
        if url.startswith("http://other"):
            return (200, {}, good) if url.endswith("b.ttl") else (404, {}, b"")
        acronym = url.split("/")[4]
        if acronym == "a" and params:
            return 200, {"Content-Disposition": 'attachment; filename="a.ttl.gz"', "Content-Type": "text/turtle"}, packed
        if acronym == "b":
            return (200, {}, b"<html>") if params else (500, {}, b"")
        return 403, {}, b""

    return lambda: registry.Client(send, "http://r", retries=0, sleep=lambda s: None)


def test_download_and_other_places(spark):
    connect = made_up_registry()
    kinds = "acronym string, submission_id long, catalog_status string, bp_viewing_restriction string, bp_summary_only boolean, bp_classes long, bp_master_file_name string"
    rows = [("a", 1, "ok", None, None, None, None), ("b", 2, "ok", "public", False, 5, None), ("c", 3, "ok", "private", None, 1, None), ("d", 4, "ok", None, True, 1, None), ("e", 5, "ok", None, None, 2, None)]
    catalog = spark.createDataFrame([*rows, ("f", -1, "no_submission", None, None, None, None), ("g", 7, "ok", None, None, 1, None)], kinds)
    before = spark.createDataFrame([{"acronym": "e", "submission_id": 5, "status": "failed", "attempts": 1}, {"acronym": "g", "submission_id": 7, "status": "ok", "attempts": 1}], schemas.DOWNLOADS)
    after, files = C.download(catalog, before, connect, F.lit("t"), "r", tasks=2)
    got = {r.acronym: r for r in after.collect()}
    assert {k: (r.status, r.attempts) for k, r in got.items()} == {"a": ("ok", 1), "b": ("failed", 1), "c": ("private", 1), "d": ("summary_only", 1), "e": ("failed", 1), "g": ("ok", 1)}
    a = got["a"]
    assert (a.variant, a.server_filename, a.archive_type, a.eval_bytes, a.run_id, a.error) == ("rdf:submission", "a.ttl.gz", "gzip", len(GOOD), "r", None)
    assert '"html_response"' in got["b"].attempts_log and got["b"].error == "failed (HTTP 500)" and [gzip.decompress(r.content) for r in files.collect()] == [GOOD]
    again = {r.acronym: (r.status, r.attempts) for r in C.download(catalog, after, connect, F.lit("t"), "r", again=True, only=["E", "A"])[0].collect()}
    assert again["e"] == ("not_downloadable", 2) and again["a"] == ("ok", 1)
    first = C.download(catalog, before, connect, F.lit("t"), "r", limit=3)[0]
    assert {r.acronym for r in first.collect()} == {"b", "c", "d", "e", "g"}

    runs = spark.createDataFrame([{"acronym": "a", "submission_id": 1, "status": "done", "summary_json": '{"entities": 3}'}], schemas.EVALUATIONS)
    places = spark.createDataFrame([("a", "http://other/a.ttl"), ("b", "http://other/{x}/b.ttl"), ("e", "http://other/e.ttl"), ("z", "http://other/z.ttl")], "acronym string, url string")
    moved, fetched, outcomes = C.download_from(places, after, runs, connect, F.lit("t2"), "r2")
    assert dict(outcomes.collect()) == {"a": "already_scored", "b": "ok", "e": "not_found", "z": "unknown_acronym"}
    b = {r.acronym: r for r in moved.collect()}["b"]
    assert (b.status, b.variant, b.url, b.bytes, b.error, b.run_id) == ("ok", "url:other", "http://other/{x}/b.ttl", len(GOOD), None, "r2")
    assert [x["outcome"] for x in json.loads(b.attempts_log)] == ["html_response", "html_response", "failed", "ok"]
    assert [(r.acronym, r.submission_id) for r in fetched.collect()] == [("b", 2)]
    assert dict(C.download_from(places, after, runs, connect, F.lit("t2"), "r2", force=True)[2].collect())["a"] == "not_found"
