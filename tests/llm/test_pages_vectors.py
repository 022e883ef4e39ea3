"""Operators over pages and vectors, and the pipeline, against brute force."""

from __future__ import annotations

import json
import math
import re
from collections import Counter

import numpy as np
import pytest

from quillon.llm import ann, components, html_wrapper, mixing, packing, shared, url_filter
from test_documents import mixed_model


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


class TestComponents:
    def test_against_union_find(self, spark):
        rnd = np.random.default_rng(5)
        pairs = [(int(a), int(b)) for a, b in rnd.integers(0, 400, (260, 2))] + [(k, k + 1) for k in range(500, 560)] + [(7, 7)]
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in pairs:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
        got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        linked = {x for a, b in pairs if a != b for x in (a, b)}
        assert got == {x: find(x) for x in linked}

    def test_empty(self, spark):
        assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


class TestRunningTotal:
    def test_against_sorted_rows(self, spark, monkeypatch):
        from pyspark.sql import functions as F

        rows = [(k % 3 if k % 7 else None, k, k % 5) for k in range(500)]
        df = spark.createDataFrame(rows, "g int, k long, n long").withColumn("digest", F.unhex(F.md5(F.col("k").cast("string"))))
        got = shared.running_total(df, ["g"], ["digest", "k"], "digest", F.col("n"), 10_000_000, "before").collect()
        total = {}
        for r in sorted(got, key=lambda r: bytes(r.digest)):
            assert r.before == total.get(r.g, 0)
            total[r.g] = r.before + r.n


class TestUrlFilter:
    def rows(self):
        return [
            (0, "http://a.Example.ORG/es/1?x", None), (1, "https://example.org/en/12", ""), (2, "http://x.org/p#q/r", '<a href="http://bad.net/x">'), (3, "http://x.com/fr/", None),
            (4, "http://x.com/de/1", None), (5, None, None), (6, "no scheme", None), (7, "http://bad.net/", None), (8, "http://notexample.org/es/", None), (9, "http://", None),
            (10, "http://hub.net/", '<a href="http://y.com/de/1"> <a href=//bad.net>'), (11, "http://y.com/de/1", None), (11, "http://y.com/de/1", None),
        ]

    def test_rules(self, spark):
        rows = url_filter.filter_urls(spark.createDataFrame(self.rows(), "page_id long, url string, html string")).collect()
        got = {r.page_id: (r.host, r.path, r.rule) for r in rows}
        assert got[0] == ("a.example.org", "/es/1", "example.org/es/")
        assert got[1] == ("example.org", "/en/12", "example.org/en/1")
        assert got[2] == ("x.org", "/p", "org/")
        assert got[3][2] == "com/fr/" and got[4][2] == "com/de/"
        assert got[5] == got[6] == got[9] == ("", "", None)
        assert got[8][2] == "org/"
        assert len(rows) == 13

    def test_propagation(self, spark):
        rows = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(self.rows(), "page_id long, url string, html string")).collect()}
        assert rows[7].verdict == "allow" and rows[7].trust > 0  # x.org, which is allowed, links to it
        assert rows[10].verdict == "block" and rows[10].distrust > 0  # it links to y.com, which is blocked
        assert rows[5].verdict == "allow"

    def test_verdicts_do_not_rest_on_rounded_scores(self, spark):
        rows, far = [(0, "http://h0.com/de/1", None)], 4
        for k in range(far):  # nearly all distrust of each host goes to its busy neighbour
            rows += [(k + 1, f"http://h{k + 1}.net/", f'<a href="http://h{k}.{"net" if k else "com"}/x">')]
            rows += [(100 + k, f"http://busy{k}.net/", f'<a href="http://h{k}.{"net" if k else "com"}/x">')] * 2000
        got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).where("page_id < 100").collect()}
        assert got[far].distrust == 0.0  # as shown
        assert [got[k].verdict for k in range(far + 1)] == ["block"] * (far + 1)

    def test_chains_longer_than_the_shown_rounds(self, spark):
        rows = [(0, "http://h0.com/de/1", None)] + [(k, f"http://h{k}.net/", f'<a href="http://h{k - 1}.{"net" if k > 1 else "com"}/x">') for k in range(1, 13)]
        got = {r.page_id: r.verdict for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        assert got == dict.fromkeys(range(13), "block")

    def test_settled_scores_solve_the_equations(self, spark):
        edges = [("a", "b", 1.0), ("b", "a", 1.0), ("b", "c", 3.0)]
        _, last = url_filter.settled(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame([("trust", "a", 2.0)], "kind string, host string, seed double"))
        a = (1 - url_filter.DAMPING) / (1 - url_filter.DAMPING**2 / 4)
        want = {"a": a, "b": url_filter.DAMPING * a, "c": url_filter.DAMPING**2 * 0.75 * a}
        got = {r.host: r.score for r in last.collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[h], want[h], rel_tol=1e-6) for h in want)

    def test_pagerank_against_matrix(self, spark):
        edges = [("a", "b", 1.0), ("a", "c", 3.0), ("b", "c", 1.0), ("c", "a", 2.0), ("d", "a", 1.0)]
        seeds = [("trust", "a", 3.0), ("trust", "d", 1.0), ("distrust", "c", 2.0)]
        out = url_filter.propagated(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame(seeds, "kind string, host string, seed double")).collect()
        names = "abcd"
        for kind in ("trust", "distrust"):
            m = np.zeros((4, 4))
            for s, t, w in edges:
                i, j = (names.index(s), names.index(t)) if kind == "trust" else (names.index(t), names.index(s))
                m[j, i] += w
            m = m / np.maximum(m.sum(axis=0), 1e-300)
            start = np.array([sum(v for k, h, v in seeds if k == kind and h == n) for n in names])
            start = (1 - url_filter.DAMPING) * start / start.sum()
            x = start.copy()
            for _ in range(url_filter.ROUNDS):
                x = start + url_filter.DAMPING * m @ x
            got = {r.host: r.score for r in out if r.kind == kind}
            assert all(math.isclose(got.get(n, 0.0), v, abs_tol=1e-12) for n, v in zip(names, x, strict=True))

    def test_empty(self, spark):
        assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string, html string, host string")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T {k}</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a><li>About</ul></nav><!-- ad --><div class="ad">Buy {k}</div>
<div class="cookie-notice">We use cookies</div><aside>Side {k}</aside>
<article><h1>Title &amp; {k}</h1><div class="share">Share this</div><p><b>First {k}<br>line.<p>Second&nbsp;<i>para</i>graph {k}</p>
<p class="note">Read our terms</p><form><input name=q> Search</form><ul><li>one<li>two {k}</ul></article>
<section id="comments"><p>Nice! {k}</p></section><footer>&copy; x</footer>"""


class TestHtml:
    def test_main_text(self):
        assert html_wrapper.main_text(PAGE.format(k=1)) == "Title & 1 First 1 line. Second paragraph 1 Read our terms one two 1"
        assert html_wrapper.main_text("") == ""
        assert html_wrapper.main_text("<p>a<p>b &#233;&eacute;") == "a b éé"
        assert html_wrapper.main_text("<script>never closed") == ""
        assert html_wrapper.main_text("plain < text") == "plain < text"

    def test_wrapper_folds_repeats_and_options(self):
        trees = [html_wrapper.Page(f"<article><h1>{t}</h1>{''.join(f'<p>{t}{i}</p>' for i in range(n))}{extra}</article>").tree() for t, n, extra in (("a", 2, ""), ("b", 5, "<table>x</table>"), ("c", 1, ""))]
        wrapper = html_wrapper.aligned(html_wrapper.aligned(trees[0], trees[1]), trees[2])
        assert html_wrapper.expression(wrapper) == "<article><h1>#text</h1>(<p>#text</p>)+(<table>x</table>)?</article>"
        other = html_wrapper.aligned(trees[2], html_wrapper.aligned(trees[1], trees[0]))
        assert html_wrapper.expression(other) == html_wrapper.expression(wrapper)

    def test_repeated_groups(self):
        tree = html_wrapper.Page("<main>" + "<h2>a</h2><p>b</p><p>c</p>" * 3 + "</main>").tree()
        assert html_wrapper.expression(tree) == "<main>(<h2>a</h2>)+(<p>#text</p>)+</main>"

    def test_template_texts_and_regions_come_from_the_host(self, spark):
        page = "<html><body><div class='top'>My site</div><div class='box'><p>Story {k} goes on and on for {k} words.</p><p class='sub'>Subscribe now</p><p>More on {k}.</p></div></body></html>"
        rows = [(k, f"http://h.org/{k}", page.format(k=f"{k} x{k}")) for k in range(6)] + [(7, None, None), (8, "http://solo.org", PAGE.format(k=8)), (8, "http://solo.org", PAGE.format(k=8))]
        df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, rules string").repartition(3)
        got = html_wrapper.extracted(df).collect()
        by_id = {r.page_id: r for r in got}
        assert by_id[3].text == "Story 3 x3 goes on and on for 3 x3 words. More on 3 x3."
        assert (by_id[7].text, by_id[7].n_chars, by_id[7].url) == ("", 0, None)
        assert by_id[8].n_chars == len(by_id[8].text) > 0
        assert len(got) == len(rows)

    def test_long_template_texts_come_from_the_host(self, spark):
        notice = "All rights to these pages are held by the publisher. " * 5
        page = "<body><div><p>" + notice + "</p></div><article><h1>Head {k}</h1><p>" + notice + "</p><div>Story {k} " + "goes on " * 30 + "{k}</div></article></body>"
        plain = "<body><div><p>" + notice + "</p></div><section><h1>Head {k}</h1><div>Story {k} " + "goes on " * 30 + "{k}</div></section></body>"
        rows = [(k, "http://a.org/", page.format(k=k)) for k in range(5)] + [(10 + k, "http://b.org/", plain.format(k=k)) for k in range(5)]
        got = {r.page_id: r.text for r in html_wrapper.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
        for k in range(5):
            want = f"Head {k} Story {k} " + "goes on " * 30 + str(k)
            assert got[k] == want and got[10 + k] == want

    def test_copies_of_a_page_keep_their_texts(self, spark):
        article = "<article><h1>Headline</h1><p>" + "One long paragraph. " * 12 + "</p><p>" + "Another long one. " * 12 + "</p><ul><li>a<li>b</ul></article>"
        rows = [(k, "http://a.org/", f"<body>{article}</body>") for k in range(4)]
        rows += [(10 + k, "http://b.org/", f"<body><section>{article}</section><div>{k} views</div></body>") for k in range(4)]
        got = html_wrapper.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
        assert {r.text for r in got} == {html_wrapper.main_text(article)}

    def test_cells_that_differ_in_a_page_are_no_template(self):
        trees = [html_wrapper.Page(f"<table><tr><th>Name</th><td>x{k}</td></tr><tr><th>Age</th><td>{k}</td></tr></table>").tree() for k in range(4)]
        wrapper = trees[0]
        for tree in trees[1:]:
            wrapper = html_wrapper.aligned(wrapper, tree)
        assert html_wrapper.rules_of(wrapper, 4) == []

    def test_no_varying_text_is_dropped(self, spark):
        page = "<body><h1>Head {k}</h1><p>Lead {k}</p><div class='box'><p>" + "Body {k} of a story. " * 20 + "</p></div></body>"
        other = "<body><h1>Only {k}</h1><div class='box'>short {k}</div><section>Rest {k}</section></body>"
        rows = [(k, "http://a.org/", (page if k < 5 else other).format(k=k)) for k in range(9)] + [(20, "http://b.org/", page.format(k=20))]
        got = {r.page_id: r.text for r in html_wrapper.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
        for k, _, html in rows:
            assert got[k] == html_wrapper.main_text(html)
            assert got[k].startswith(f"Head {k} Lead {k} Body {k}" if k < 5 or k == 20 else f"Only {k} short {k} Rest {k}")

    def test_near_copies_prove_no_template(self, spark):
        page = "<body><article><h1>Headline</h1><p>One paragraph that all of them have.</p><p class='date'>Seen {k}</p></article></body>"
        plain = "<body><div><h1>Headline</h1><p>One paragraph that all of them have.</p><div>Seen {k}</div></div></body>"
        two = "<body><div><h1>Two pages</h1><div>{k}</div></div></body>"
        rows = [(k, "http://a.org/", page.format(k=k)) for k in range(5)] + [(10 + k, "http://b.org/", plain.format(k=k)) for k in range(5)]
        rows += [(20 + k, "http://c.org/", two.format(k=("this story is told " if k % 2 else "that one is also told ") * 9)) for k in range(8)]
        got = {r.page_id: r.text for r in html_wrapper.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)).collect()}
        for k, _, html in rows:
            assert got[k] == html_wrapper.main_text(html)
            assert got[k].startswith(("Headline One paragraph that all of them have. Seen", "Two pages th"))

    def test_only_the_alignment_finds_the_text(self, spark):
        page = (
            "<body><table><tr><td>Daily Times of the town</td></tr></table><div><div><b>Read also what others read today</b></div><h1>{t}</h1><div><p>{a}</p>"
            "<p>{b}</p></div></div><div><div>Written and made in a town, all rights with us</div></div></body>"
        )
        rows, want = [], {}
        for k in range(6):
            t, a, b = f"Title {k}", f"First {k} " + f"word{k} " * 12, f"Second {k} " + f"term{k * 7} " * 15
            rows.append((k, "http://t.org/", page.format(t=t, a=a, b=b)))
            want[k] = " ".join(f"{t} {a} {b}".split())
        assert all(html_wrapper.main_text(html) != want[k] for k, _, html in rows)
        got = {r.page_id: r.text for r in html_wrapper.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
        assert got == want

    def test_deep_and_wide_pages(self):
        deep = "<div>" * 10_000 + "text" + "</div>" * 10_000
        wide = "<body>" + "".join(f"<p>a{k}</p><h2>b{k}</h2>" if k % 3 else f"<ul><li>c{k}</ul>" for k in range(9_000)) + "</body>"
        for html in (deep, wide):
            trees = [html_wrapper.Page(html.replace("text", f"text {k}").replace("a1<", f"z{k}<")).tree() for k in range(4)]
            wrapper = trees[0]
            for tree in trees[1:]:
                wrapper = html_wrapper.unflat(json.loads(json.dumps(html_wrapper.flat(html_wrapper.aligned(wrapper, tree)))))
            assert html_wrapper.expression(wrapper)
            rules = html_wrapper.template_tree(html_wrapper.rules_of(wrapper, 4))
            assert html_wrapper.main_text(html, rules)

    def test_class_words_in_an_article(self):
        html = "<article><section class='related-work'>Related work.</section><div class='search-results'>Found.</div><div class='share-buttons'>Share</div><p class='ad'>Buy</p></article>"
        assert html_wrapper.main_text(html) == "Related work. Found."

    def test_many_partial_wrappers_fold_in_shares(self, spark, monkeypatch):
        monkeypatch.setattr(html_wrapper, "FOLDS", 2)
        rows = [(k, "http://h.org/", f"<div><p>a{k}</p>{'<ul><li>x</ul>' if k % 3 else ''}</div>") for k in range(12)]
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(12)
        (row,) = html_wrapper.wrappers(df).collect()
        assert row.pages == 12
        assert html_wrapper.expression(html_wrapper.unflat(json.loads(row.wrapper))) == "<div><p>#text</p>(<ul><li>x</li></ul>)?</div>"

    def test_empty(self, spark):
        assert html_wrapper.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


class TestNearest:
    def table(self, spark, n=700, dim=24):
        rnd = np.random.default_rng(8)
        centres = rnd.normal(size=(10, dim))
        v = [[float(np.float32(x)) for x in centres[k % 10] + 0.7 * rnd.normal(size=dim)] for k in range(n)]
        v[40] = v[41] = v[42] = v[60]
        rows = [(k, x, 0) for k, x in enumerate(v)]
        rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * dim, 0), (n + 3, [float("nan")] * dim, 0), (n + 4, [None] * dim, 0), (None, v[0], 0), (5, v[5], 0), (2000, [1.0, 2.0], 0), (2001, [2.0, 1.0], 0)]
        return v, spark.createDataFrame(rows, "vec_id long, embedding array<float>, dim int").repartition(3)

    @pytest.mark.parametrize("block", [16384, 100])
    def test_recall_and_scores(self, spark, block):
        v, df = self.table(spark)
        x, ids = np.array([*v, v[5]]), np.array([*range(700), 5])
        rows = ann.nearest(df, block_rows=block, query_rows=8).collect()
        hits = total = 0
        by = {}
        for r in rows:
            by.setdefault(r.query_id, []).append(r)
        assert set(by) == {*range(0, 700, 20), 2000}
        for q, own in by.items():
            own.sort(key=lambda r: r.rank)
            if q == 2000:
                assert [(r.vec_id, r.score) for r in own] == [(2001, 4.0)]
                continue
            scores = (x * x[q]).sum(axis=1)
            order = [int(ids[i]) for i in np.lexsort((ids, -scores)) if i != q][:20]
            hits += sum(min(order.count(i), [r.vec_id for r in own].count(i)) for i in set(order))
            total += 20
            assert [r.rank for r in own] == list(range(1, 21))
            assert all(math.isclose(r.score, scores[r.vec_id], rel_tol=1e-12) for r in own)
            assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert hits / total >= 0.9

    def test_only_what_collides_is_verified(self):
        rnd = np.random.default_rng(3)
        x = rnd.normal(size=(4000, 16))
        index = ann.Index(np.arange(4000), np.arange(4000), x, ann.lines_of(17, 2))
        for q in range(0, 200, 20):
            places, scores, verified = index.search(x[q], q, 20, ann.THRESHOLD, ann.GROWTH, ann.VERIFIED, ann.LEAST_VERIFIED)
            assert len(places) == 20 and q not in places and verified < 0.12 * len(x)
            assert scores.tolist() == sorted(scores, reverse=True)

    def test_rows_that_share_an_identifier(self, spark):
        rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0])]
        got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(
            [(0, 1, 1, 3.0), (0, 2, 1, 3.0), (0, 3, 0, 2.0), (0, 1, 1, 6.0), (0, 2, 1, 6.0), (0, 3, 0, 2.0)]
        )

    @pytest.mark.parametrize("size", [1e-170, 1e-20, 1e20, 1e39, 1e200])
    def test_any_magnitude(self, spark, size):
        rows = [(k, [float(k % 7 + 1) * size, float(k % 5 - 2) * size, size]) for k in range(60)]
        rows += [(100 + k, [1.0, float(k), -2.0]) for k in range(40)]
        got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5).collect()
        count = {}
        for r in got:
            count[r.query_id] = count.get(r.query_id, 0) + 1
        assert count == dict.fromkeys((0, 20, 40, 100, 120), 5)
        x = dict(rows)
        for r in got:
            with np.errstate(over="ignore"):
                want = float((np.array(x[r.query_id]) * np.array(x[r.vec_id])).sum())
            assert r.score == want or math.isclose(r.score, want, rel_tol=1e-12)

    def test_many_blocks_are_merged_in_steps(self, spark, monkeypatch):
        monkeypatch.setattr(ann, "_FOLD", 2)
        v, df = self.table(spark, 200, 8)
        one = {(r.query_id, r.rank): r.vec_id for r in ann.nearest(df, block_rows=1000, verified=1.0).collect()}
        assert one == {(r.query_id, r.rank): r.vec_id for r in ann.nearest(df, block_rows=25, verified=1.0).collect()}

    def test_identifiers_are_whole_numbers(self, spark):
        with pytest.raises(TypeError):
            ann.nearest(spark.createDataFrame([("a", [1.0])], "vec_id string, embedding array<float>"))

    def test_fewer_than_asked_for(self, spark):
        df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (3, [0.5, 0.5])], "vec_id long, embedding array<float>")
        assert [(r.rank, r.vec_id, r.score) for r in ann.nearest(df).orderBy("rank").collect()] == [(1, 1, 0.5), (2, 3, 0.5)]

    def test_empty(self, spark):
        assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


class TestPipeline:
    def test_stages_against_brute_force(self, spark, docs, tmp_path):
        import corpus_pipeline

        docs.write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([(i, 0) for i in range(7, 40)] + [(41, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        now = spark.read.parquet(f"{tmp_path}/documents.parquet")
        kept = []
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = shared.share(stage(spark, now, str(tmp_path))).df
            assert now.columns == docs.columns, name
            kept.append([(r.doc_id, r.text, r.source) for r in now.collect()])
        clean, unique, distinct, mixed = kept
        assert len(clean) == docs.count()
        # Exact copies: the smallest identifier of each normalised text.
        first = {}
        for row in sorted(clean, key=lambda r: (r[0] is None, r[0] or 0)):
            first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or ""), row)
        assert Counter(r[0] for r in unique) == Counter(r[0] for r in first.values())
        # Near copies: one of each set of documents that links of five-word shingles join.
        sets = [shingles(t, 5) for _, t, _ in unique]
        group = list(range(len(unique)))
        for i in range(len(unique)):
            for j in range(i):
                if sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
        by_group = {}
        for g, row in zip(group, unique, strict=True):
            by_group.setdefault(g, []).append(row)
        assert len(distinct) == len(by_group)
        assert all(sum(row in distinct for row in rows) == 1 for rows in by_group.values())
        # The mix, and then its pieces.
        want = [(i, t) for i, _, _, _, own in mixed_model([(i, s, t) for i, t, s in distinct], mixing.BLOCK_WORDS) for _, _, t in own]
        assert Counter((i, t) for i, t, _ in mixed) == Counter(want)
        pieces = {}
        for r in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: r.piece):
            assert r.n_tokens <= packing.MOST_TOKENS
            pieces.setdefault((r.doc_id, r.row), []).extend(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert Counter((i, *w) for (i, _), w in pieces.items()) == Counter((i, *re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in want)

    def test_empty_tables(self, spark, no_docs, tmp_path):
        import corpus_pipeline

        no_docs.write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
