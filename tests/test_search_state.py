"""Search, state and results against small cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quillon import schemas
from quillon.plans import results as R
from quillon.plans import search as S
from quillon.plans import state as St


def test_relevance(spark):
    hits = [("bird", 0, "X", ["  BIRD "], []), ("bird", 1, "Y", ["b"], ["c"]), ("bird", 2, "X", None, None), ("bird", 3, "Z", ["z"], None), ("bird", 4, None, ["bird"], None)]
    rows = {r.acronym: r for r in S.grouped_hits(spark.createDataFrame(hits, schemas.HITS)).collect()}
    assert [(rows[a].relevance, rows[a].best_rank, rows[a].exact, rows[a].hits) for a in "XYZ"] == [(1.0, 1, True, 2), (0.214, 2, False, 1), (0.107, 4, False, 1)]
    assert set(rows) == {"X", "Y", "Z"} and rows["X"].example == "  BIRD "


def test_ranks(spark):
    rows = [("k", n, "scored", v) for n, v in zip("abcd", [7.0, 7.0, 5.0, None], strict=True)] + [("k", "e", "pending", 9.0)]
    out = {r.n: r for r in S.with_ranks(spark.createDataFrame(rows, "keyword string, n string, status string, flat double"), ("flat",)).collect()}
    assert [out[n].rank_flat for n in "abcde"] == [1, 1, 3, None, None]
    assert {r.scored_count for r in out.values()} == {4}


def test_cache_and_cascade(spark):
    now = F.to_timestamp(F.lit("2026-01-02 12:00:00"))
    match = [("A", 1.0, 1, True, 1, None)]
    cache = spark.createDataFrame([("a", "bioportal", match, 3, "2026-01-01 12:06:00"), ("b", "bioportal", match, 4, "2026-01-01 11:54:00")], schemas.KEYWORD_CACHE.replace("fetched_at timestamp", "fetched_at string"))
    cache = cache.withColumn("fetched_at", F.to_timestamp("fetched_at"))
    state = S.cached(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "keyword string"), cache, now)
    assert {r.keyword: r.state for r in state.collect()} == {"a": "fresh", "b": "stale", "c": "miss", "d": "miss"}
    kind = cache.schema["matches"].dataType.simpleString()
    live = spark.createDataFrame([("d", match, 9)], f"keyword string, matches {kind}, total_hits long")
    local = spark.createDataFrame([("c", match)], f"keyword string, matches {kind}")
    out = {r.keyword: (r.source, r.total_hits, r.note) for r in S.cascade(state, live, local).collect()}
    assert out == {"a": ("cache", 3, None), "b": ("stale_cache", 4, S.STALE_NOTE), "c": ("fallback", None, S.FALLBACK_NOTE), "d": ("bioportal", 9, None)}


def test_full_text_phrases_and_diacritics(spark):
    docs = [("A", "Covid 19 study", "x"), ("B", "covid in 19 places", "y"), ("C", "Étude générale", "covid"), *[(f"D{k}", "other things", "z") for k in range(9)]]
    words = spark.createDataFrame([("covid-19",), ("etude",), ("covid places",), ("!!",)], "keyword string")
    out = {}
    for r in S.full_text(words, spark.createDataFrame(docs, "acronym string, name string, description string"), ["name", "description"]).collect():
        out.setdefault(r.keyword, {})[r.acronym] = (r.relevance, r.best_rank)
    assert out["covid-19"] == {"A": (1.0, 1)}
    assert out["etude"] == {"C": (1.0, 1)}
    assert out["covid places"]["B"] == (1.0, 1) and set(out["covid places"]) == {"A", "B", "C"}
    assert "!!" not in out


def test_validation_and_explanation(spark):
    rows = S.valid_keywords(spark.createDataFrame([("  ＡＢ  c ",), ("   ",), ("x" * 201,), (None,)], "keyword string")).collect()
    assert [(r.q[:4], r.error) for r in rows] == [("ab c", None), ("", "empty"), ("xxxx", "too_long"), ("", "empty")]
    df = spark.createDataFrame([(1, True, None), (2, False, "e"), (0, False, None)], "hits long, exact boolean, example string")
    assert [r[0] for r in df.select(S.explanation()).collect()] == ["1 matching term, exact name match", '2 matching terms, for example "e"', ""]


def test_enriched_and_sorted(spark):
    serving = spark.createDataFrame([{"provider": "p", "acronym": "A", "status": "scored", "flat_score": 5.0, "categories": "x;;y", "description": "d" * 500}, {"provider": "p", "acronym": "B", "status": "empty", "flat_score": 9.0, "name": ""}], schemas.SERVING)
    matches = spark.createDataFrame([("A", 0.5, 1), ("B", 1.0, 2), ("C", 0.7, 3)], "acronym string, relevance double, best_rank int")
    out = {r.acronym: r for r in S.enriched(matches, serving).collect()}
    assert (out["A"].flat, out["A"].categories, len(out["A"].description)) == (5.0, ["x", "y"], 400)
    assert (out["B"].flat, out["B"].name) == (None, "B")
    assert (out["C"].status, out["C"].status_detail, out["C"].registry_url[-2:]) == ("pending", S.PENDING_DETAIL, "/C")
    assert [r.acronym for r in S.sorted_results(S.enriched(matches, serving), "flat").collect()] == ["A", "B", "C"]


RUN = "acronym string, submission_id bigint, status string, attempts int, error string, describe_score double, summary_json string"


def runs(spark, *rows):
    return spark.createDataFrame([r + (None,) * (7 - len(r)) for r in rows], RUN)


def test_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, u string, v string")
    new = spark.createDataFrame([(2, None), (3, "n")], "k int, u string")
    assert sorted(map(tuple, St.upsert(old, new, ["k"]).collect())) == [(1, "a", "x"), (2, None, "y"), (3, "n", None)]
    assert sorted(map(tuple, St.replace(old, new, ["k"]).collect()))[1:] == [(2, None, None), (3, "n", None)]


def test_queue_and_attempts(spark):
    downloads = spark.createDataFrame([(a, 1, "ok", s) for a, s in zip("abcde", [5, None, 1, 2, 9], strict=True)] + [("f", 1, "failed", 1)], "acronym string, submission_id bigint, status string, eval_bytes bigint")
    ev = runs(spark, ("a", 1, "done", 1), ("b", 1, "crashed", 2), ("c", 1, "crashed", 1), ("d", 2, "done", 1), ("e", 1, "running", 2))
    assert [(r.acronym, r.action) for r in St.in_order(St.work_queue(downloads, ev)).collect()] == [("b", "gave_up"), ("c", "run"), ("d", "run"), ("e", "run")]
    assert {r.acronym: r.status for r in St.interrupted(ev).collect()}["e"] == "gave_up"
    assert {r.acronym: (r.status, r.attempts) for r in St.requeued(ev, ("crashed",), ["B"]).collect()}["b"] == ("pending", 0)


def test_run_accounting(spark):
    ev = spark.createDataFrame([{"acronym": "a", "submission_id": 1, "status": "done", "attempts": 1, "describe_score": 3.0, "error": "old"}], schemas.EVALUATIONS)
    keys = spark.createDataFrame([("a", 1), ("b", 1)], "acronym string, submission_id bigint")
    now = St.started(ev, keys, "run", F.lit("t"))
    assert {r.acronym: (r.status, r.attempts, r.error, r.describe_score) for r in now.collect()} == {"a": ("running", 2, None, 3.0), "b": ("running", 1, None, None)}
    results = spark.createDataFrame([("a", 1, "crashed", 9.0), ("b", 1, "done", 4.0)], "acronym string, submission_id bigint, status string, describe_score double")
    assert {r.acronym: (r.status, r.describe_score) for r in St.finished(now, results).collect()} == {"a": ("gave_up", None), "b": ("done", 4.0)}


def test_nightly(spark):
    catalog = spark.createDataFrame([("A", 5, "ok"), ("B", None, "no_submission"), ("C", 2, "error"), ("D", 3, "ok"), ("E", None, "ok")], "acronym string, submission_id bigint, status string")
    serving = spark.createDataFrame([("A", 4), ("C", 1), ("D", 3), ("E", -1)], "acronym string, submission_id bigint")
    assert {r.acronym: r.reason for r in St.nightly_diff(catalog, serving).collect()} == {"A": "new submission (4 -> 5)", "B": "new ontology"}
    assert [(r.acronym, r.deferred) for r in St.nightly_diff(catalog, serving, cap=1).orderBy("acronym").collect()] == [("A", False), ("B", True)]
    assert [r.acronym for r in St.nightly_diff(catalog, serving, only=["d"]).collect()] == ["D"]


def test_keep_old(spark):
    kind = "provider string, acronym string, submission_id bigint, status string, status_detail string, core_average double, updated_at string"
    old = spark.createDataFrame([("p", "A", 4, "scored", None, 7.0, "o"), ("p", "B", 4, "scored", None, 6.0, "o"), ("p", "C", 1, "empty", None, None, "o")], kind)
    new = spark.createDataFrame([("p", "A", 5, "timed_out", "t", None, "n"), ("p", "B", 5, "parse_failed", "bad", None, "n"), ("p", "C", 2, "failed", "x", None, "n")], kind)
    out = {r.acronym: r for r in St.merged_serving(old, new).collect()}
    assert (out["A"].submission_id, out["A"].status, out["A"].core_average, out["A"].updated_at) == (4, "scored", 7.0, "n")
    assert out["A"].status_detail.startswith("Submission 5 is not scored yet (timed_out on the nightly runner); the scores shown are for submission 4.")
    assert (out["B"].submission_id, out["B"].status, out["B"].core_average) == (5, "parse_failed", None)
    assert out["C"].status == "failed"


def test_web_status(spark):
    rows = [
        ("no_submission", "done", 1, None, "ok", "no_submission"), ("ok", "done", 0, None, "ok", "empty"), ("ok", "done", 3, None, "ok", "scored"), ("ok", "parse_failed", None, "not_an_ontology:html", "ok", "not_an_ontology"),
        ("ok", "parse_failed", None, None, "ok", "parse_failed"), ("ok", None, None, None, "html_response", "failed"), ("ok", "interrupted", None, None, "ok", "pending"), ("error", None, None, None, None, "pending"),
        ("ok", "memory_error", None, None, "ok", "too_large"), ("ok", None, None, None, "private", "not_downloadable"), ("ok", None, None, None, "skipped_too_large", "too_large"),
    ]
    df = spark.createDataFrame(rows, "catalog_status string, eval_status string, entities long, eval_error string, download_status string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", R.web_status()).collect())


def test_plans(spark):
    catalog = spark.createDataFrame([("A", json.dumps({"definitionProperty": [{"@id": "http://d"}, "x", "http://www.w3.org/2000/01/rdf-schema#comment"], "hasOntologyLanguage": "OBO", "pullLocation": "http://x/a.obo"}), json.dumps({"classes": 20, "classesWithNoDefinition": 2})), ("B", None, "null"), ("C", "{}", "{}")], "acronym string, submission_json string, metrics_json string")
    downloads = spark.createDataFrame([("A", 1, "ok"), ("B", 1, "not_found"), ("C", 1, "ok")], "acronym string, submission_id bigint, status string")
    ev = runs(spark, ("A", 1, "done", 1, None, None, json.dumps({"entities": 5, "define_defined": 3, "flat_cycle_back_edges": 1, "flat_max_depth": 4})), ("C", 1, "done", 1, None, None, json.dumps({"entities": 0})))
    out = {r.acronym: r for r in St.upgrade_plan(catalog, downloads, ev).collect()}
    assert out["A"].reasons == "BioPortal definition property http://d; BioPortal counts 18 definitions, found 3" and out["A"].flat_recheck
    assert out["B"].download_failed and out["C"].empty
    assert {r.acronym for r in St.repair_targets(St.upgrade_plan(catalog, downloads, ev)).collect()} == {"B", "C"}
    assert [r.acronym for r in St.rescoring(St.upgrade_plan(catalog, downloads, ev), ev, "1").collect()] == ["A"]
    rows = catalog.where("acronym = 'A'").select("acronym", F.lit(7).alias("submission_id"), F.lit("rdf:latest").alias("variant"), F.lit("obo").alias("sniffed_format"), "submission_json")
    assert [(r.variant, r.url) for r in St.alternate_sources(rows).orderBy("at").collect()] == [("original:submission", "/ontologies/A/submissions/7/download"), ("obo_owl:0", "http://x/a.owl"), ("obo_owl:1", "http://purl.obolibrary.org/obo/a.owl")]


def test_pilot(spark):
    rows = spark.createDataFrame([(f"a{k}", 10 ** (k % 4 + 2) * 5) for k in range(60)] + [("none", None)], "acronym string, bp_classes long")
    got = St.pilot(rows).collect()
    assert len(got) == 20 and sorted(r.bin for r in got) == [0] * 5 + [1] * 5 + [2] * 5 + [3] * 5
    few = spark.createDataFrame([(f"a{k}", 5) for k in range(30)], "acronym string, bp_classes long")
    assert St.pilot(few).count() == 20


def test_catalog_and_exports(spark, tmp_path):
    submission = {"submissionId": 3, "hasOntologyLanguage": "OWL", "description": "it's", "naturalLanguage": ["en", "fr"], "publication": ["p"], "contact": [{"name": "N"}, "x"], "submissionStatus": ["http://s/production"]}
    ontology = {"acronym": "A", "hasDomain": ["http://x/c/Health/", {"acronym": "Bio"}, "http://y/Health"], "summaryOnly": False, "viewOf": "http://x/ontologies/V"}
    catalog = spark.createDataFrame([("A", "Name", 3, "ok", None, "t", 0.1, json.dumps(ontology), json.dumps(submission), json.dumps({"classes": 7})), ("B", "b", -1, "no_submission", None, "t", 0.1, "{}", None, None)], schemas.CATALOG)
    frame = R.catalog_frame(catalog)
    row = frame.where("acronym = 'A'").first()
    assert (row.bp_categories, row.bp_view_of, row.bp_is_view, row.bp_natural_language, row.bp_contact_names, row.bp_submission_status, row.bp_classes) == ("Bio;Health", "V", True, "en;fr", "N", "production", 7)
    downloads = spark.createDataFrame([{"acronym": "A", "submission_id": 3, "status": "ok", "bytes": 5, "sha256": "s"}], schemas.DOWNLOADS)
    summary = {"entities": 2, "classes": 2, "triple_count": 9, "weakest_metric": "Flat"}
    ev = spark.createDataFrame([{"acronym": "A", "submission_id": 3, "status": "done", "seconds": 1.5, "describe_score": 8.0, "define_score": 2.0, "connection_score": 6.0, "flat_score": 4.0, "core_average": 5.0, "summary_json": json.dumps(summary)}], schemas.EVALUATIONS)
    kind = "entities bigint, classes bigint, triple_count bigint, weakest_metric string, define_bp_score double, define_bp_source string, source_version string, core_version string, define_device string"
    frame = R.results_frame(frame, downloads, ev, kind).cache()
    rows = {r.acronym: r for r in frame.collect()}
    assert (rows["A"].web_status, rows["A"].define_bp_score, rows["A"].define_bp_source, rows["A"].core_average_bp) == ("scored", 2.0, R.UNCHECKED, 5.0)
    assert rows["B"].web_status == "no_submission" and rows["B"].define_bp_source is None
    serving = R.serving_rows(frame, F.lit("u"))
    assert serving.columns == spark.createDataFrame([], schemas.SERVING).columns
    statement = R.insert_statements(serving.where("acronym = 'A'").select("acronym", "description", "describe_score", "entity_count", "version"), "t").first().value
    assert statement == "INSERT OR REPLACE INTO t (acronym, description, describe_score, entity_count, version) VALUES ('A', 'it''s', 8.0, 2, NULL);"
    assert R.full_text_statements(serving).first().value == "DELETE FROM ontology_search;"
    files = R.export(frame, str(tmp_path), F.lit("u"), details=frame.select("acronym", "entities"))
    assert len(files) == 11 and spark.read.option("header", "true").csv(f"{tmp_path}/not_scored.csv").first().acronym == "B"
    told = json.loads(spark.read.text(f"{tmp_path}/run_summary.json").first().value)
    assert told["web_status_counts"] == {"no_submission": 1, "scored": 1} and told["score_stats"]["flat_score"]["n"] == 1
    assert spark.read.option("header", "true").csv(f"{tmp_path}/data_dictionary.csv").where("`column` = 'entities'").first().non_null == "1"


def test_report():
    text = R.nightly_report([("A", "scored", 5.0), ("B", "failed", None)], [("C", "too_large")], 7, 1)
    assert "| A | scored | 5.00 |" in text and "| B | failed |  |" in text and "C (too_large)" in text
    assert pytest is not None


def test_half_even(spark):
    rows = spark.createDataFrame([(6.125,), (6.135,), (2.5,), (None,)], "x double").select(R.half_even(F.col("x")).alias("y")).collect()
    assert [r.y for r in rows] == [6.12, 6.14, 2.5, None]


def test_queue_order_totals_and_slowest(spark):
    queue = spark.createDataFrame([("a", 1, 5, "run"), ("b", 1, None, "run"), ("c", 1, 2, "gave_up")], "acronym string, submission_id long, eval_bytes long, action string")
    assert [r.acronym for r in St.in_order(queue).collect()] == ["b", "c", "a"]
    assert [r.acronym for r in St.in_order(queue, unknown_last=True).collect()] == ["c", "a", "b"]
    assert {r.action: (r.files, r.unknown, r.bytes) for r in St.size_totals(queue).collect()} == {"run": (2, 1, 5), "gave_up": (1, 0, 2)}
    assert [r.acronym for r in R.slowest(queue, 1, "eval_bytes").collect()] == ["a"]


def test_full_text_refresh(spark):
    rows = spark.createDataFrame([("p", "A'", "n", None, "c", 1)], "provider string, acronym string, name string, description string, categories string, more int")
    assert [r.value for r in R.full_text_refresh(rows).orderBy("at").collect()] == [
        "DELETE FROM ontology_search WHERE provider = 'p' AND acronym = 'A'''" + ";",
        "INSERT INTO ontology_search (provider, acronym, name, description, categories) VALUES ('p', 'A''', 'n', NULL, 'c');",
    ]


def test_payload_and_texts(spark):
    results = spark.createDataFrame([("k", "A", 0.5, 2, 1), ("k", "B", 1.0, 1, 1)], "keyword string, acronym string, relevance double, best_rank int, scored_count long")
    sources = spark.createDataFrame([("k", "cache", None, 7), ("none", "fallback", "note", None)], "keyword string, source string, note string, total_hits long")
    got = {r.keyword: json.loads(r.body) for r in S.payload(results, sources).collect()}
    assert [r["acronym"] for r in got["k"]["results"]] == ["B", "A"] and got["k"]["count"] == 2 and got["k"]["total_hits"] == 7 and got["k"]["scored_count"] == 1
    assert got["none"] == {"keyword": "none", "source": "fallback", "note": "note", "total_hits": None, "count": 0, "scored_count": 0, "results": []}
    row = spark.range(1).select(S.rank_text(F.lit(2), F.lit(9)), S.rank_text(F.lit(None).cast("int"), F.lit(9)), S.status_text(F.lit("empty")), S.status_text(F.lit("?"))).first()
    assert tuple(row) == ("#2 of 9", "", "No entities found", "Not scored")


def test_many_query_tokens_filter_by_a_join(spark, monkeypatch):
    docs = spark.createDataFrame([("A", "Cell death of cells", "cell"), ("B", None, "death cell death"), ("C", "", ""), ("D", "other", None)], "acronym string, name string, about string")
    terms = S.query_terms(spark.createDataFrame([("cell death",), ("cell-death none",)], "keyword string"))

    def scores():
        return sorted((r.keyword, r.acronym, r.matched, round(r.score, 9)) for r in S.bm25(terms, docs, ["name", "about"]).collect())

    few = scores()
    monkeypatch.setattr(S, "LITERAL_TOKENS", 0)
    assert few == scores() and {r[:2] for r in few} == {("cell death", "A"), ("cell death", "B"), ("cell-death none", "A"), ("cell-death none", "B")}
