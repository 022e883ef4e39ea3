"""Keyword search: hits to ranked ontologies, cached, live or from the local full-text index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import js_round, normalised_query
from quillon.session import materialise, spread

METRICS = ("average_bp", "describe", "define_bp", "connection", "flat")
CACHE_HOURS = 24
MOST_LETTERS = 200
FULL_TEXT_HITS = 40
FEW_HITS = 5
K1, B = 1.2, 0.75
#: Query terms are broadcast up to this many, and joined by a shuffle beyond.
BROADCAST_TERMS = 100_000
#: Tokens of query terms are literals of the plan up to this many, and filter by a join beyond.
LITERAL_TOKENS = 1_000
# Fixed notes.
STALE_NOTE = "BioPortal did not answer in time, so these matches are from an earlier search of the same keyword."
FALLBACK_NOTE = "BioPortal did not answer in time, so these are approximate matches on ontology names and descriptions."
PENDING_DETAIL = "Not scored yet (new since the last scoring run)."

_ACCENTED = "àáâãäåāăąçćĉċčďèéêëēĕėęěĝğġģĥìíîïĩīĭįĵķĺļľñńņňòóôõöōŏőŕŗřśŝşšţťùúûüũūŭůűųŵýÿŷźżž"
_PLAIN = "aaaaaaaaacccccdeeeeeeeeegggghiiiiiiiijklllnnnnoooooooorrrssssttuuuuuuuuuuwyyyzzz"


def folded(text: Column) -> Column:
    """Lower case without the diacritics of Latin letters."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.octet_length(low) == F.length(low), low).otherwise(F.translate(low, _ACCENTED, _PLAIN))


def valid_keywords(keywords: DataFrame, column: str = "keyword") -> DataFrame:
    """Normalised keywords of 1 to 200 letters, and the error of the others."""
    q = keywords.withColumn("q", normalised_query(F.col(column)))
    error = F.when(F.col("q") == "", "empty").when(F.length("q") > MOST_LETTERS, "too_long")
    return q.withColumn("error", error)


def first_string(labels: Column) -> Column:
    return F.try_element_at(labels, F.lit(1))


def grouped_hits(hits: DataFrame, normal: bool = True) -> DataFrame:
    """(keyword, acronym, relevance, hits, exact, best_rank, example) of hits (see quillon.schemas, rank from 0).

    An ontology's raw relevance is the sum of 1 / (rank + 1) of its hits, and one more if a label or synonym is the keyword;
    relevance is its share of the keyword's largest. Sums are taken over sorted terms, so they do not hang on partitions.
    """
    labels = F.concat(F.coalesce("pref_label", F.array().cast("array<string>")), F.coalesce("synonym", F.array().cast("array<string>")))
    if normal:
        flat = hits.where("acronym IS NOT NULL").withColumn("_label", F.explode_outer(labels)).withColumn("_same", normalised_query(F.col("_label")) == F.col("keyword"))
        exact = flat.groupBy("keyword", "acronym").agg(F.coalesce(F.bool_or("_same"), F.lit(False)).alias("exact"))
    else:
        exact = hits.where("acronym IS NOT NULL").groupBy("keyword", "acronym").agg(F.coalesce(F.bool_or(F.array_contains(labels, F.col("keyword"))), F.lit(False)).alias("exact"))
    groups = hits.where("acronym IS NOT NULL").groupBy("keyword", "acronym").agg(
        F.count(F.lit(1)).alias("hits"), (F.min("rank") + 1).cast("int").alias("best_rank"),
        F.min_by(first_string(F.col("pref_label")), F.col("rank")).alias("example"),
        F.sum((F.lit(1.0) / (F.col("rank") + 1)).cast("decimal(38,18)")).cast("double").alias("rr"),
    )
    raw = groups.join(exact, ["keyword", "acronym"]).withColumn("raw", F.col("rr") + F.col("exact").cast("int"))
    top = raw.groupBy("keyword").agg(F.greatest(F.lit(1e-9), F.max("raw")).alias("top"))
    return raw.join(top, "keyword").select("keyword", "acronym", js_round(F.col("raw") / F.col("top")).alias("relevance"), "hits", "exact", "best_rank", "example")


def with_ranks(results: DataFrame, metrics: tuple[str, ...] = METRICS, by: str = "keyword", scored: str = "status = 'scored'") -> DataFrame:
    """Adds rank_<metric> (1, 2, 2, 4; null where the metric is) among scored rows, and scored_count on every row."""
    is_scored = F.expr(scored)
    out = results
    for metric in metrics:
        value = F.when(is_scored, F.col(metric))
        order = Window.partitionBy(by, value.isNotNull()).orderBy(value.desc())
        out = out.withColumn(f"rank_{metric}", F.when(value.isNotNull(), F.rank().over(order)).cast("int"))
    return out.withColumn("scored_count", F.count_if(is_scored).over(Window.partitionBy(by)))


def enriched(matches: DataFrame, serving: DataFrame) -> DataFrame:
    """Matches with the scores of the serving table; unknown ontologies are pending. Scores only where scored."""
    rows = serving.select(
        F.col("acronym").alias("_a"), "name", "description", "categories", "ontology_language", "version", "released", "registry_url", "status",
        "status_detail", F.col("describe_score").alias("describe"), F.col("define_score").alias("define"), F.col("define_bp_score").alias("define_bp"),
        "define_bp_source", F.col("connection_score").alias("connection"), F.col("flat_score").alias("flat"), F.col("core_average").alias("average"),
        F.col("core_average_bp").alias("average_bp"), F.col("entity_count").alias("entities"), F.col("triple_count").alias("triples"), "evaluated_at",
    )
    joined = matches.join(rows, F.col("acronym") == F.col("_a"), "left")
    known, scored = F.col("_a").isNotNull(), F.coalesce(F.col("status") == "scored", F.lit(False))
    score = lambda c: F.when(scored, F.col(c)).alias(c)
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    kinds = F.when(full("categories").isNotNull(), F.filter(F.split("categories", ";"), lambda x: x != "")).otherwise(F.array().cast("array<string>"))
    return joined.select(
        *matches.columns, F.coalesce(full("name"), F.col("acronym")).alias("name"),
        F.when(known, F.col("status")).otherwise("pending").alias("status"), F.when(known, F.col("status_detail")).otherwise(PENDING_DETAIL).alias("status_detail"),
        *[score(c) for c in ("average_bp", "average", "describe", "define_bp", "define", "connection", "flat")], "define_bp_source",
        F.substring(full("description"), 1, 400).alias("description"), kinds.alias("categories"), F.col("ontology_language").alias("language"), "version", "released",
        "entities", "triples", "evaluated_at",
        F.coalesce(full("registry_url"), F.concat(F.lit("https://bioportal.bioontology.org/ontologies/"), F.url_encode("acronym"))).alias("registry_url"),
    )


def cached(keywords: DataFrame, cache: DataFrame, now: Column, provider: str = "bioportal") -> DataFrame:
    """(keyword, state, matches, total_hits): fresh within 24 hours, else stale, or a miss."""
    own = cache.where(F.col("provider") == provider).select("keyword", "matches", "total_hits", "fetched_at")
    age = now.cast("double") - F.col("fetched_at").cast("double")
    state = F.when(F.col("fetched_at").isNull(), "miss").when(age / 3600 < CACHE_HOURS, "fresh").otherwise("stale")
    return keywords.join(own, "keyword", "left").select("keyword", state.alias("state"), "matches", "total_hits")


def cascade(cache_state: DataFrame, live: DataFrame, fallback: DataFrame) -> DataFrame:
    """(keyword, source, note, matches, total_hits): fresh cache, live result, stale cache, full-text index, in this order.

    ``live`` (keyword, matches, total_hits) has no row for a keyword that was not answered in time; ``fallback`` is
    (keyword, matches).
    """
    live = live.select("keyword", F.col("matches").alias("live"), F.col("total_hits").alias("live_hits"), F.lit(True).alias("answered"))
    fallback = fallback.select("keyword", F.col("matches").alias("local"))
    joined = cache_state.join(live, "keyword", "left").join(fallback, "keyword", "left")
    fresh, answered, stale = F.col("state") == "fresh", F.col("answered").isNotNull(), F.col("state") == "stale"
    pick = lambda a, b, c, d: F.when(fresh, a).when(answered, b).when(stale, c).otherwise(d)
    null = F.lit(None)
    return joined.select(
        "keyword", pick(F.lit("cache"), F.lit("bioportal"), F.lit("stale_cache"), F.lit("fallback")).alias("source"),
        pick(null, null, F.lit(STALE_NOTE), F.lit(FALLBACK_NOTE)).alias("note"),
        pick(F.col("matches"), F.col("live"), F.col("matches"), F.col("local")).alias("matches"),
        pick(F.col("total_hits"), F.col("live_hits"), F.col("total_hits"), null).alias("total_hits"),
    )


def query_terms(keywords: DataFrame) -> DataFrame:
    """(keyword, t, term): the distinct terms of normalised keywords, without signs other than _ and -."""
    kept = F.filter(F.transform(F.split("keyword", " "), lambda t: F.regexp_replace(t, r"[^\p{L}\p{N}_-]", "")), lambda t: t != "")
    return keywords.select("keyword", F.posexplode(kept).alias("t", "term"))


def postings(terms: DataFrame, documents: DataFrame, columns: list[str], key: str = "acronym") -> tuple[DataFrame, DataFrame]:
    """(key, c, position, token) of the tokens of the indexed columns that stand in a term, and (key, length).

    Texts are read and cut once: what is written of a text is its length and the places of wanted tokens. Up to
    ``LITERAL_TOKENS`` wanted tokens filter each text's list, more filter its exploded tokens by a join.
    """
    parts = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.coalesce(F.col(c), F.lit("")).alias("text")) for i, c in enumerate(columns)])).alias("part")
    texts = spread(documents.select(key, *columns)).select(key, parts)
    cut = texts.select(key, "part.c", _words(folded(F.col("part.text"))).alias("w"))
    wanted = terms.select(F.explode(_words(folded(F.col("term")))).alias("token")).distinct()
    few = [r[0] for r in wanted.limit(LITERAL_TOKENS + 1).collect()]
    if len(few) > LITERAL_TOKENS:
        index = cut.select(key, "c", F.posexplode("w").alias("position", "token")).join(wanted, "token", "left_semi")
        return index.select(key, "c", "position", "token"), cut.groupBy(key).agg(F.sum(F.size("w")).alias("length"))
    places = F.transform("w", lambda x, i: F.struct(i.alias("position"), x.alias("token")))
    hits = F.when(F.arrays_overlap("w", _strings(few)), F.filter(places, lambda x: x["token"].isin(few)))
    kept = materialise(cut.select(key, "c", F.size("w").alias("n"), hits.alias("hits")))
    index = kept.select(key, "c", F.explode("hits").alias("hit")).select(key, "c", "hit.position", "hit.token")
    return index, kept.groupBy(key).agg(F.sum("n").alias("length"))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def term_frequencies(terms: DataFrame, index: DataFrame, key: str = "acronym") -> DataFrame:
    """(keyword, t, key, tf): how often each term stands in each document; a term of several tokens is a phrase."""
    words = terms.select("keyword", "t", F.posexplode(_words(folded(F.col("term")))).alias("at", "token"))
    sizes = words.groupBy("keyword", "t").agg(F.count(F.lit(1)).alias("size"))
    few = words.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    found = index.join(F.broadcast(words) if few else words, "token").select("keyword", "t", key, "c", (F.col("position") - F.col("at")).alias("start"), "at")
    starts = found.groupBy("keyword", "t", key, "c", "start").agg(F.countDistinct("at").alias("got")).join(sizes, ["keyword", "t"]).where("got = size")
    return starts.groupBy("keyword", "t", key).agg(F.count(F.lit(1)).alias("tf"))


def bm25(terms: DataFrame, documents: DataFrame, columns: list[str], key: str = "acronym") -> DataFrame:
    """(keyword, key, matched, score): BM25 of every document that holds a term; negative, lower is better."""
    index, lengths = postings(terms, documents, columns, key)
    tf = term_frequencies(terms, index, key)
    df = tf.groupBy("keyword", "t").agg(F.count(F.lit(1)).alias("df"))
    totals = lengths.agg(F.count(F.lit(1)).alias("docs"), F.avg("length").alias("mean"))
    idf = F.greatest(F.lit(1e-6), F.log((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    weight = idf * (F.col("tf") * (K1 + 1)) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    joined = tf.join(df, ["keyword", "t"]).join(lengths, key).join(F.broadcast(totals))  # totals is one row
    return joined.groupBy("keyword", key).agg(F.count(F.lit(1)).alias("matched"), (-F.sum(weight)).alias("score"))


def full_text(keywords: DataFrame, documents: DataFrame, columns: list[str], key: str = "acronym", most: int = FULL_TEXT_HITS) -> DataFrame:
    """(keyword, key, relevance, best_rank): all terms first; where that finds few, documents with any term follow."""
    terms = query_terms(keywords)
    sizes = terms.groupBy("keyword").agg(F.count(F.lit(1)).alias("terms"))
    scored = materialise(bm25(terms, documents, columns, key)).join(sizes, "keyword").withColumn("score", F.round("score", 9))

    def best(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("keyword").orderBy("score", key)
        return rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)

    every = best(scored.where("matched = terms"))
    few = sizes.join(every.groupBy("keyword").agg(F.count(F.lit(1)).alias("n")), "keyword", "left").where(f"coalesce(n, 0) < {FEW_HITS} AND terms > 1")
    some = best(scored.join(few.select("keyword"), "keyword", "left_semi")).join(every.select("keyword", key), ["keyword", key], "left_anti")
    both = every.select("keyword", key, "score", F.lit(0).alias("pass"), "r").unionByName(some.select("keyword", key, "score", F.lit(1).alias("pass"), "r"))
    place = F.row_number().over(Window.partitionBy("keyword").orderBy("pass", "r"))
    top = F.min("score").over(Window.partitionBy("keyword"))
    relevance = F.when(top < 0, F.greatest(F.lit(0.01), js_round(F.col("score") / top))).otherwise(1.0)
    return both.select("keyword", key, relevance.alias("relevance"), place.alias("best_rank"))


def sorted_results(results: DataFrame, metric: str = "relevance") -> DataFrame:
    """By a metric, missing values last, then by relevance, then by acronym."""
    if metric == "relevance":
        return results.orderBy(F.desc("relevance"), "best_rank", "acronym")
    return results.orderBy(F.coalesce(F.col(metric), F.lit(-1.0)).desc(), F.desc("relevance"), "acronym")


def explanation() -> Column:
    """Why an ontology is among the results."""
    count = F.when(F.col("hits") > 0, F.concat(F.col("hits").cast("string"), F.lit(" matching term"), F.when(F.col("hits") == 1, "").otherwise("s")))
    example = F.when(F.col("exact"), "exact name match").when(F.coalesce("example", F.lit("")) != "", F.concat(F.lit('for example "'), F.col("example"), F.lit('"')))
    return F.concat_ws(", ", count, example)


def shown(score: Column, digits: int = 2) -> Column:
    """Fixed decimals; NaN and infinities spelled as printf does, which Java spells otherwise."""
    endless = F.when(F.isnan(score), "nan").when(score == float("inf"), "inf").when(score == float("-inf"), "-inf")
    return F.when(score.isNotNull(), F.coalesce(endless, F.format_string(f"%.{digits}f", score))).otherwise("n/a")


def rank_text(rank: Column, total: Column) -> Column:
    """A rank among the scored ontologies of a search; empty without a rank."""
    return F.when(rank.isNotNull(), F.concat(F.lit("#"), rank.cast("string"), F.lit(" of "), total.cast("string"))).otherwise("")


#: How a status is shown.
STATUS_TEXTS = {
    "scored": "Scored", "pending": "Not scored yet", "empty": "No entities found", "not_an_ontology": "Not an ontology file", "parse_failed": "File could not be read",
    "timed_out": "Took too long", "too_large": "File too large", "failed": "Failed", "not_downloadable": "No file to download", "no_submission": "No submission",
}


def status_text(status: Column) -> Column:
    """The words for a status."""
    known = F.create_map(*[F.lit(x) for pair in STATUS_TEXTS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, status), F.lit("Not scored"))


def payload(results: DataFrame, sources: DataFrame) -> DataFrame:
    """(keyword, body): the answer to each keyword as one JSON document, results in relevance order, nulls kept.

    ``results`` as ``with_ranks`` of ``enriched`` gives them; ``sources`` (keyword, source, note, total_hits) as ``cascade``
    does. A keyword has a bounded number of results, those of one answer of the registry or of the full-text index.
    """
    columns = [c for c in results.columns if c not in ("keyword", "scored_count")]
    key = F.struct((-F.col("relevance")).alias("far"), "best_rank", "acronym")
    listed = F.array_sort(F.collect_list(F.struct(key.alias("at"), F.struct(*columns).alias("row"))))
    rows = results.groupBy("keyword").agg(F.transform(listed, lambda x: x["row"]).alias("results"), F.max("scored_count").alias("scored_count"))
    own = sources.select("keyword", "source", "note", "total_hits").join(rows, "keyword", "left")
    none = F.array().cast(dict(rows.dtypes)["results"])
    body = F.struct(
        "keyword", "source", "note", "total_hits", F.coalesce(F.size("results"), F.lit(0)).alias("count"),
        F.coalesce("scored_count", F.lit(0)).alias("scored_count"), F.coalesce("results", none).alias("results"),
    )
    return own.select("keyword", F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))


def bar_width(score: Column) -> Column:
    return F.when(score.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), score * 10))).otherwise(0.0)


def latency(results: DataFrame) -> DataFrame:
    """(endpoint, keyword, result_count, distinct_ontologies, top_ontologies) of registry answers (endpoint, keyword, rank, acronym)."""
    counts = results.groupBy("endpoint", "keyword").agg(F.count(F.lit(1)).alias("result_count"), F.countDistinct("acronym").alias("distinct_ontologies"))
    per = results.where("acronym IS NOT NULL").groupBy("endpoint", "keyword", "acronym").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first"))
    listed = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "first", "acronym"))), 1, 10)
    top = per.groupBy("endpoint", "keyword").agg(F.array_join(F.transform(listed, lambda x: x["acronym"]), ";").alias("top_ontologies"))
    return counts.join(top, ["endpoint", "keyword"], "left")
