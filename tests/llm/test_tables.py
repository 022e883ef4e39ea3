"""The registered queries over the smallest tables: against SQL where there is one, else against brute force."""

from __future__ import annotations

import html
import os
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from quillon.llm import license_scan, packing, queries

DATA = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def table(spark, name, folder=DATA):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    base = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels"):
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    want = base.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)

    def one(v):
        return f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    order = sorted(columns)
    rows = sorted(tuple(one(r[c]) for c in order) for r in got.collect())
    assert rows == sorted(tuple(one(r[columns.index(c)]) for c in order) for r in want.fetchall())


def test_op2_batches(spark):
    rows = queries.op2_packing(spark, DATA).collect()
    docs = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in table(spark, "documents").collect()}
    total = Counter()
    lengths = Counter()
    filled = defaultdict(int)
    for r in rows:
        total[r.doc_id] += r.n_tokens
        if r.n_tokens:
            lengths[r.n_tokens] += 1
            filled[r.bucket, r.batch] += r.bucket_len
    assert dict(total) == docs
    n = np.array(sorted(lengths))
    bounds = packing.best_bounds(n, np.array([lengths[x] for x in n]), packing.BUCKETS)
    assert sorted({r.bucket_len for r in rows if r.bucket is not None}) == bounds
    assert max(filled.values()) <= packing.BATCH_TOKENS


def test_op4_held_out(spark):
    rows = queries.op4_toxicity(spark, "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else LARGER)
    labels = table(spark, "labels", "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else LARGER)
    held = rows.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.98
    assert sum(r.predicted for r in held if not r.toxic) / sum(not r.toxic for r in held) < 0.005


def test_op7_whole_articles(spark):
    got = {r.page_id: r for r in queries.op7_html_extraction(spark, DATA).collect()}
    pages = table(spark, "pages").collect()
    assert len(got) == len(pages)
    for r in pages:
        article = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1])
        want = re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", article))).strip()
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_op8_base_places(spark):
    got = {r.doc_id: r for r in queries.op8_license_scan(spark, LARGER).collect()}
    for r in table(spark, "documents", LARGER).collect():
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (r.text or "").encode()))
        places, labels = [], set()
        for phrase, label in license_scan.BASE.items():
            codes = [w.encode() for w in phrase.split()]
            at = [k for k in range(len(words)) if words[k : k + len(codes)] == codes]
            places += at
            labels |= {label} if at else set()
        own = got[r.doc_id]
        assert (own.n_words, own.n_base, own.first_word, own.last_word) == (len(words), len(places), min(places, default=None), max(places, default=None))
        assert own.base_labels == ",".join(sorted(labels)) and labels <= set(filter(None, own.labels.split(",")))


def test_op10_recall(spark):
    rows = queries.op10_nearest_neighbours(spark, LARGER).collect()
    data = [(r.vec_id, r.embedding) for r in table(spark, "embeddings", LARGER).collect()]
    ids, vectors = np.array([i for i, _ in data]), np.array([v for _, v in data], dtype=np.float64)
    found = defaultdict(set)
    for r in rows:
        found[r.query_id].add(r.vec_id)
    hits = 0
    for q in found:
        scores = (vectors * vectors[ids == q][0]).sum(axis=1)
        order = [i for i in ids[np.lexsort((ids, -scores))] if i != q][:20]
        hits += len(found[q] & set(order))
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    assert hits / (20 * len(found)) >= 0.9
