"""Triples, state tables and hits derived from the star-schema tables, in SQL that Spark and DuckDB both run.

The benchmark tables hold no ontologies. Here regions become ontologies r0 to r4: nations are classes, customers and suppliers individuals,
orders and parts give links, documents give definitions. Parts form a second hierarchy (size below brand below type) in the
ontology of their key. The statements name tables in braces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import vocab as V
from quillon.schemas import TRIPLES as TRIPLE_SCHEMA
from quillon.session import scratch_dir

_E = "http://example.com/"
_NULL = "CAST(NULL AS STRING)"


def _text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _iri(kind: str, key: str) -> str:
    return f"'{_E}{kind}/' || {_text(key)}"


def _onto(key: str) -> str:
    return f"'r' || {_text(key)}"


def _row(source: str, onto: str, s: str, p: str, o: str, s_kind: str = "iri", o_kind: str = "iri", lang: str = _NULL, dtype: str = _NULL) -> str:
    return f"SELECT {onto} AS onto_id, {s} AS s, '{s_kind}' AS s_kind, '{p}' AS p, {o} AS o, '{o_kind}' AS o_kind, {lang} AS o_lang, {dtype} AS o_dtype FROM {source}"


_NAT = (
    "(SELECT n_nationkey AS k, n_name AS name, n_regionkey AS r, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS rn, "
    "lag(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS prev FROM {nation}) AS nat"
)
_CUST = "{customer} JOIN {nation} ON c_nationkey = n_nationkey"
_SUPP = "{supplier} JOIN {nation} ON s_nationkey = n_nationkey"
_DOCS = "{part} JOIN {documents} ON p_partkey = doc_id"
_PART, _R = "p_partkey % 5", "r"
_BUYS = (
    "(SELECT DISTINCT o_custkey AS c, l_suppkey AS sk, cn.n_regionkey AS r FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey "
    "JOIN {customer} ON c_custkey = o_custkey JOIN {nation} AS cn ON cn.n_nationkey = c_nationkey JOIN {supplier} ON s_suppkey = l_suppkey "
    "JOIN {nation} AS sn ON sn.n_nationkey = s_nationkey WHERE cn.n_regionkey = sn.n_regionkey) AS buys"
)
_CLASS, _OBJECT = f"'{V.OWL}Class'", f"'{V.OBJECT_PROPERTY}'"
_LANG = "CASE WHEN p_partkey % 3 = 0 THEN 'en' WHEN p_partkey % 3 = 1 THEN 'de' END"

FAMILIES = [
    _row("{region}", _onto("r_regionkey"), _iri("region", "r_regionkey"), V.TYPE, _CLASS),
    _row(_NAT, _onto(_R), _iri("nation", "k"), V.TYPE, _CLASS),
    _row(f"{_NAT} WHERE rn = 1 OR rn > r + 1", _onto(_R), _iri("nation", "k"), V.SUBCLASS, _iri("region", "r")),
    _row(f"{_NAT} WHERE rn > 1 AND rn <= r + 1", _onto(_R), _iri("nation", "k"), V.SUBCLASS, _iri("nation", "prev")),
    _row(f"(SELECT DISTINCT {_PART} AS r, p_brand AS b, p_type AS t FROM {{part}}) AS x", _onto(_R), f"'{_E}brand/' || replace(b, ' ', '_')", V.SUBCLASS, f"'{_E}type/' || replace(t, ' ', '_')"),
    _row(f"(SELECT DISTINCT {_PART} AS r, p_brand AS b, p_size AS z FROM {{part}}) AS x", _onto(_R), _iri("size", "z"), V.SUBCLASS, f"'{_E}brand/' || replace(b, ' ', '_')"),
    _row(_CUST, _onto("n_regionkey"), _iri("customer", "c_custkey"), V.TYPE, _iri("nation", "n_nationkey")),
    _row(_SUPP, _onto("n_regionkey"), _iri("supplier", "s_suppkey"), V.TYPE, _iri("nation", "n_nationkey")),
    _row("{part}", _onto(_PART), _iri("part", "p_partkey"), V.TYPE, f"'{_E}brand/' || replace(p_brand, ' ', '_')"),
    _row("{region}", _onto("r_regionkey"), _iri("region", "r_regionkey"), V.LABEL, "r_name", o_kind="literal"),
    _row(_NAT, _onto(_R), _iri("nation", "k"), V.LABEL, "name", o_kind="literal", lang="'en'"),
    _row(f"{_CUST} WHERE c_custkey % 3 <> 0", _onto("n_regionkey"), _iri("customer", "c_custkey"), V.LABEL, "c_name", o_kind="literal"),
    _row("{part} WHERE p_partkey % 7 <> 0", _onto(_PART), _iri("part", "p_partkey"), V.LABEL, "p_name", o_kind="literal", lang=_LANG),
    _row("{part} WHERE p_partkey % 2 = 0", _onto(_PART), _iri("part", "p_partkey"), V.PREF_LABEL, "p_brand || ' ' || p_name", o_kind="literal", lang="'en'"),
    _row(f"{_DOCS} WHERE p_partkey % 3 <> 0", _onto(_PART), _iri("part", "p_partkey"), V.COMMENT, "text", o_kind="literal", lang="lang"),
    _row(f"{_DOCS} WHERE p_partkey % 9 = 1", _onto(_PART), _iri("part", "p_partkey"), V.DCTERMS + "description", "source", o_kind="literal"),
    _row(f"{_DOCS} WHERE p_partkey % 3 = 0", _onto(_PART), _iri("part", "p_partkey"), _E + "terms#definition", "text", o_kind="literal"),
    _row("{orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey", _onto("n_regionkey"), _iri("customer", "o_custkey"), _E + "terms#placed", _iri("order", "o_orderkey")),
    _row("(SELECT DISTINCT l_partkey AS p, l_suppkey AS sk FROM {lineitem}) AS x", _onto("p % 5"), _iri("part", "p"), _E + "terms#suppliedBy", _iri("supplier", "sk")),
    _row(_BUYS, _onto(_R), _iri("customer", "c"), _E + "terms#buysFrom", _iri("supplier", "sk")),
    _row(f"{_NAT} WHERE prev IS NOT NULL", _onto(_R), _iri("nation", "prev"), _E + "terms#nextTo", _iri("nation", "k")),
    _row(_CUST, _onto("n_regionkey"), _iri("customer", "c_custkey"), _E + "terms#segment", "c_mktsegment", o_kind="literal"),
    _row(_CUST, _onto("n_regionkey"), _iri("customer", "c_custkey"), _E + "terms#balance", _text("CAST(floor(c_acctbal) AS BIGINT)"), o_kind="literal", dtype=f"'{V.XSD}integer'"),
    _row("{region}", _onto("r_regionkey"), f"'{_E}terms#buysFrom'", V.TYPE, _OBJECT),
    _row("{region}", _onto("r_regionkey"), f"'{_E}terms#note'", V.TYPE, f"'{V.ANNOTATION}'"),
    _row(f"{_CUST} WHERE c_custkey % 4 = 0", _onto("n_regionkey"), _iri("customer", "c_custkey"), _E + "terms#note", "c_name", o_kind="literal"),
    _row(f"{_SUPP} WHERE s_suppkey % 2 = 0", _onto("n_regionkey"), _iri("supplier", "s_suppkey"), V.XL_ALT_LABEL, f"'_:x' || {_text('s_suppkey')}", o_kind="bnode"),
    _row(f"{_SUPP} WHERE s_suppkey % 4 = 0", _onto("n_regionkey"), f"'_:x' || {_text('s_suppkey')}", V.XL_FORM, "s_name", s_kind="bnode", o_kind="literal"),
    # Every second nation lies below a restriction; every fifth equals an intersection of a nation and a restriction.
    _row(f"{_NAT} WHERE k % 2 = 0", _onto(_R), _iri("nation", "k"), V.SUBCLASS, f"'_:r' || {_text('k')}", o_kind="bnode"),
    _row(_NAT, _onto(_R), f"'_:r' || {_text('k')}", V.TYPE, f"'{V.RESTRICTION}'", s_kind="bnode"),
    _row(_NAT, _onto(_R), f"'_:r' || {_text('k')}", V.ON_PROPERTY, f"'{_E}terms#' || CASE WHEN k % 4 = 0 THEN 'buysFrom' ELSE 'segment' END", s_kind="bnode"),
    _row(_NAT, _onto(_R), f"'_:r' || {_text('k')}", V.OWL + "someValuesFrom", _iri("region", "r"), s_kind="bnode"),
    _row(f"{_NAT} WHERE rn = 5", _onto(_R), _iri("nation", "k"), V.EQUIVALENT, f"'_:e' || {_text('k')}", o_kind="bnode"),
    _row(f"{_NAT} WHERE rn = 5", _onto(_R), f"'_:e' || {_text('k')}", V.INTERSECTION, f"'_:l' || {_text('k')}", s_kind="bnode", o_kind="bnode"),
    _row(f"{_NAT} WHERE rn = 5", _onto(_R), f"'_:l' || {_text('k')}", V.FIRST, _iri("nation", "prev"), s_kind="bnode"),
    _row(f"{_NAT} WHERE rn = 5", _onto(_R), f"'_:l' || {_text('k')}", V.REST, f"'_:m' || {_text('k')}", s_kind="bnode", o_kind="bnode"),
    _row(f"{_NAT} WHERE rn = 5", _onto(_R), f"'_:m' || {_text('k')}", V.FIRST, f"'_:r' || {_text('k')}", s_kind="bnode", o_kind="bnode"),
    _row(f"{_NAT} WHERE rn = 5", _onto(_R), f"'_:m' || {_text('k')}", V.REST, f"'{V.NIL}'", s_kind="bnode"),
    _row("{part} WHERE p_partkey % 50 = 0", _onto(_PART), _iri("part", "p_partkey"), V.DEPRECATED, "CASE WHEN p_partkey % 100 = 0 THEN ' TRUE' ELSE 'false' END", o_kind="literal"),
    _row("{region}", _onto("r_regionkey"), _iri("onto", "r_regionkey"), V.TYPE, f"'{V.ONTOLOGY}'"),
    _row("{region} WHERE r_regionkey % 2 = 0", _onto("r_regionkey"), _iri("onto", "r_regionkey"), V.VERSION, _iri("version", "r_regionkey")),
    _row(_NAT, _onto(_R), _iri("onto", "r"), V.IMPORTS, _iri("import", "k % 3")) .replace("SELECT ", "SELECT DISTINCT ", 1),
]

TRIPLES = " UNION ALL ".join(FAMILIES)

#: Cosine of the part's label and definition vectors: rows 2k and 2k + 1 of embeddings, over and over.
COSINES = (
    "SELECT onto_id, iri, c AS define_cosine FROM (SELECT 'r' || CAST(p_partkey % 5 AS STRING) AS onto_id, '" + _E + "part/' || CAST(p_partkey AS STRING) AS iri, "
    "p_partkey % (SELECT count(*) / 2 FROM {embeddings}) AS k FROM {part}) AS p JOIN {cosine} AS v ON v.k = p.k"
)

CATALOG = (
    "SELECT 'C' || CAST(c_custkey AS STRING) AS acronym, c_name AS name, CASE WHEN c_custkey % 11 = 0 THEN -1 ELSE c_custkey % 6 + 1 END AS submission_id, "
    "CASE WHEN c_custkey % 11 = 0 THEN 'no_submission' WHEN c_custkey % 37 = 0 THEN 'error' ELSE 'ok' END AS status, "
    "CASE WHEN c_custkey % 37 = 0 THEN 'HTTP 500' END AS error, c_mktsegment AS language, c_custkey AS k, c_acctbal AS balance FROM {customer}"
)
DOWNLOADS = (
    "SELECT 'C' || CAST(c_custkey AS STRING) AS acronym, CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE c_custkey % 6 + 1 END AS submission_id, "
    "CASE c_custkey % 10 WHEN 0 THEN 'not_downloadable' WHEN 1 THEN 'failed' WHEN 2 THEN 'skipped_too_large' WHEN 3 THEN 'html_response' ELSE 'ok' END AS status, "
    "CASE WHEN c_custkey % 17 <> 0 THEN CAST(floor(abs(c_acctbal) * 100) AS BIGINT) END AS eval_bytes, CASE WHEN c_custkey % 10 = 1 THEN 'timeout' WHEN c_custkey % 10 = 3 THEN '' END AS error "
    "FROM {customer} WHERE c_custkey % 11 <> 0"
)
EVALUATIONS = (
    "SELECT 'C' || CAST(c_custkey AS STRING) AS acronym, c_custkey % 6 + 1 AS submission_id, "
    "CASE c_custkey % 9 WHEN 0 THEN 'parse_failed' WHEN 1 THEN 'crashed' WHEN 2 THEN 'running' WHEN 3 THEN 'timeout' WHEN 4 THEN 'memory_limit' ELSE 'done' END AS status, "
    "c_custkey % 4 AS attempts, CASE WHEN c_custkey % 18 = 0 THEN 'not_an_ontology:html' WHEN c_custkey % 9 = 0 THEN 'bad' WHEN c_custkey % 9 = 1 THEN '' END AS error, "
    "CASE WHEN c_custkey % 9 > 4 THEN c_custkey % 5 END AS entities, "
    "CASE WHEN c_custkey % 9 > 4 THEN (c_custkey % 101) / CAST(10.0 AS DOUBLE) END AS describe_score, CASE WHEN c_custkey % 9 > 4 THEN (c_custkey % 89) / CAST(9.0 AS DOUBLE) END AS define_score, "
    "CASE WHEN c_custkey % 9 > 4 THEN (c_custkey % 97) / CAST(11.0 AS DOUBLE) END AS connection_score, CASE WHEN c_custkey % 9 > 4 THEN c_custkey % 11 END AS flat_score, "
    "CASE WHEN c_custkey % 9 > 6 THEN (c_custkey % 83) / CAST(8.3 AS DOUBLE) END AS define_bp_score FROM {customer} WHERE c_custkey % 7 <> 0"
)
#: Hits of a keyword (a language): documents by number, their source as ontology, their first words as label.
HITS = (
    "SELECT lang AS keyword, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS INT) AS rank, CASE WHEN doc_id % 29 <> 0 THEN source END AS acronym, "
    "split_part(text, ' ', 1) AS label, CASE WHEN doc_id % 17 = 0 THEN upper(lang) ELSE source END AS synonym FROM {documents}"
)
#: A scores row for two sources of three.
SCORES = (
    "SELECT source AS acronym, CASE WHEN length(source) = 4 THEN 'scored' ELSE 'empty' END AS status, CAST(count(*) % 7 AS DOUBLE) AS average_bp, "
    "CASE WHEN count(*) % 3 <> 0 THEN CAST(sum(n_chars) % 10 AS DOUBLE) END AS described FROM {documents} WHERE source <> 'src3' GROUP BY source"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def derived(spark: SparkSession, sf_dir: str, statement: str, **more: DataFrame) -> DataFrame:
    """A statement of this module over the tables of a folder."""
    used = {n: table(spark, sf_dir, n) for n in _NAMES if "{" + n + "}" in statement}
    return spark.sql(statement, **used, **more)


def plain(statement: str, **more: str) -> str:
    """The same for DuckDB, where tables go by their names."""
    for name in _NAMES:
        statement = statement.replace("{" + name + "}", name)
    for name, text in more.items():
        statement = statement.replace("{" + name + "}", text)
    return statement


_WRITTEN: dict[tuple[str, str], str] = {}


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived triples as a triple table is kept: Parquet by predicate, written once an application and folder.

    Rebalancing joins what is small and splits a predicate of an ontology that is large.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = f"{scratch_dir(spark)}/triples-{uuid.uuid4().hex}"
        derived(spark, sf_dir, TRIPLES).hint("rebalance", F.col("p"), F.col("onto_id")).write.partitionBy("p").parquet(path)
        _WRITTEN[key] = path
    return spark.read.schema(TRIPLE_SCHEMA).parquet(_WRITTEN[key])
