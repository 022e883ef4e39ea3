"""HTML extraction by wrappers: union-free regular expressions inferred from the pages of a host.

A page is read as a stream of block elements and texts. Aligning two streams of a host resolves each mismatch:
different texts become a text slot, elements that only one of them has become optional, and
neighbours of one kind, or short groups of kinds that follow each other again and again, become
repeated groups. The result, an expression without unions, is the wrapper of both; wrappers align
with wrappers in the same way. So pages fold into wrappers in the tasks that read them, equal wrappers become one,
and the rest are folded about ``FOLDS`` at a time, round after round, until a host has one: no task ever holds a host's pages.

The wrapper tells template from content. A text slot knows how many different values it took, up to ``LEAST_PAGES``, and
how long they were. Elements whose texts are the same on all pages of a host are template if the host's pages differ
widely otherwise: slots with at least ``LEAST_PAGES`` different values must hold ``VARYING_SHARE`` of all text, so copies and near
copies of a page, however many, prove nothing (an article, a main element or what holds one is never template). Long
texts are held by their length and digest. Without an article, a main element or a class that says content, all that is
neither template nor left out is the main text. Elements whose kind or class says menu, header, footer, sidebar,
notice, advert, form or comments are left out on any page; inside an article or main element only if every word of a class name does.

Pages may be nested as deeply and as wide as they like: nothing here recurses, and siblings align in one pass that looks ahead
for the next place where they agree.

Nulls and repeats: null or empty html gives an empty text; a null url belongs to the host of no name;
repeated rows give equal rows. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.shared import share
from quillon.llm.url_filter import after_scheme, host_of

FOLDS = 16
LEAST_PAGES = 4
VARYING_SHARE = 0.25
LONGEST_SPELLED_TEXT = 160
GROUP_ELEMENTS = 4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|select|title)\b(?:\"[^\"]*\"|'[^']*'|[^'\">]+)*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">]+)*+)>"
    r"|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_MARKS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SCOPES = frozenset("article aside body div main section table td th tr ul ol dl blockquote form header footer nav figure".split())
_LEFT_OUT = frozenset("nav footer aside form button menu dialog head fieldset object video audio canvas map".split())
_MAIN_WORDS = frozenset("article content entry main post story".split())
_LEFT_OUT_WORDS = frozenset(
    "ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies dialog discussion disqus "
    "disclaimer footer gdpr hidden login masthead menu modal nav navbar navigation navigationbar newsletter notice notification outbrain pager pagination "
    "popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription taboola toc toolbar tooltip topbar warning widget widgets complementary contentinfo".split()
)
#: In an article, a class name counts only if it is made of these words and neutral ones.
_LEFT_OUT_IN_MAIN = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr login masthead menu nav "
    "navbar navigation newsletter notice notification popup promo promoted promotion respond share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar complementary contentinfo".split()
)
_NEUTRAL = frozenset("area bar block box button buttons container form group holder icons inner item items js line links list main outer panel post section site slot top unit wrap wrapper".split())
_MODULUS = (1 << 61) - 1
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Page:
    """The block elements of a page and the texts between them, in page order."""

    __slots__ = ("kinds", "parents", "left_out", "main", "parts")

    def __init__(self, text: str) -> None:
        self.kinds, self.parents, self.left_out, self.main = [""], [-1], [False], [False]
        self.parts: list[tuple[int, str | None]] = []  # None breaks the line
        open_tags, open_at, last = [""], [0], 0
        for token in _TOKEN.finditer(text):
            if token.start() > last:
                self.parts.append((open_at[-1], text[last : token.start()]))
            last = token.end()
            tag = token["tag"]
            if tag is None:
                if token["raw"]:
                    self.parts.append((open_at[-1], None))
                continue
            tag = tag.lower()
            if token["end"]:
                if tag in open_tags:
                    while open_tags[-1] != tag:
                        open_tags.pop()
                        open_at.pop()
                    open_tags.pop()
                    at = open_at.pop()
                    self.parts.append((self.parents[at], None))
                elif tag not in _INLINE:
                    self.parts.append((open_at[-1], None))
                continue
            attributes = token["attributes"]
            names = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _MARKS.finditer(attributes)] if "=" in attributes else []
            says_out = _says_out(names, self.main[open_at[-1]])
            if tag in _INLINE and not says_out:
                continue
            if tag not in _INLINE:
                self._close(tag, open_tags, open_at)
            parent = open_at[-1]
            self.parts.append((parent, None))
            if tag in _EMPTY or attributes.endswith("/"):
                continue
            left_out = self.left_out[parent] or tag in _LEFT_OUT or (tag not in ("html", "body", "article", "main") and says_out)
            main = self.main[parent]
            if tag == "header" and not main:
                left_out = True
            if tag == "article" and says_out:
                left_out = True
            self.kinds.append(tag + "".join(sorted(f".{n}={v.strip()}" for n, v in names if n == "class")))
            self.parents.append(parent)
            self.left_out.append(left_out)
            self.main.append(main or (not left_out and (tag in ("article", "main") or "main" in [v for n, v in names if n == "role"])))
            open_tags.append(tag)
            open_at.append(len(self.kinds) - 1)
        if last < len(text):
            self.parts.append((open_at[-1], text[last:]))
        if not any(self.main):
            self._second_choice()

    @staticmethod
    def _close(tag: str, open_tags: list[str], open_at: list[int]) -> None:
        """Ends that html lets out: a block ends a paragraph, an item ends the item before."""
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}.get(tag, ())
        stop = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}.get(tag, ())
        for k in range(len(open_tags) - 1, 0, -1):
            if open_tags[k] == "p" or open_tags[k] in ends:
                del open_tags[k:], open_at[k:]
                if tag not in ("tr",):
                    return
            elif open_tags[k] in stop or (open_tags[k] in _SCOPES and open_tags[k] not in ends):
                return

    def _second_choice(self) -> None:
        """Without an article or main element: elements whose class says so."""
        for k in range(1, len(self.kinds)):
            parent = self.parents[k]
            words = set(_SPLIT.split(self.kinds[k].lower()))
            self.main[k] = self.main[parent] or (not self.left_out[k] and "=" in self.kinds[k] and bool(words & _MAIN_WORDS))

    def tree(self) -> list:
        """[kind, flags, text, children, values, chars] with repeats folded; flags 1 optional, 2 repeated.

        A text is None if it varies, and [length, digest] if it is long. ``values`` are the digests that the element's texts have
        on a page, summed over repeats: the smallest LEAST_PAGES of all pages'. ``chars`` is their length over all pages.
        """
        nodes = [[k, 0, "", [], [0], 0] for k in self.kinds]
        for at, joined in self.texts().items():
            nodes[at][2] = joined if len(joined) <= LONGEST_SPELLED_TEXT else [len(joined), _digest(joined)]
            nodes[at][4], nodes[at][5] = [_digest(joined)], len(joined)
        for k in range(1, len(nodes)):
            if not self.left_out[k]:
                nodes[self.parents[k]][3].append(nodes[k])
        for k in range(len(nodes) - 1, -1, -1):  # children have higher numbers than their parents
            nodes[k][3] = _folded(nodes[k][3])
        return nodes[0]

    def texts(self) -> dict[int, str]:
        """Each element's own text."""
        found: dict[int, list[str]] = {}
        for at, part in self.parts:
            if part is not None and not part.isspace():
                found.setdefault(at, []).append(part.strip())
        return {at: " ".join(parts) for at, parts in found.items()}

    def sums(self) -> list[int]:
        """The sum of the digests of all texts in each element, left-out ones aside."""
        out = [0] * len(self.kinds)
        for at, text in self.texts().items():
            out[at] = _digest(text)
        for k in range(len(out) - 1, 0, -1):
            if not self.left_out[k]:
                out[self.parents[k]] = (out[self.parents[k]] + out[k]) % _MODULUS
        return out


def _says_out(names: list[tuple[str, str]], in_main: bool) -> bool:
    for _, value in names:
        for name in value.split():
            words = {w for w in _SPLIT.split(name.lower()) if w}
            if words & (_LEFT_OUT_IN_MAIN if in_main else _LEFT_OUT_WORDS) and (not in_main or words <= _LEFT_OUT_IN_MAIN | _NEUTRAL):
                return True
    return False


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()) % _MODULUS


def _alike(a: list, b: list) -> bool:
    """Of one kind, and more than half of the kinds in either are in both."""
    x, y = {c[0] for c in a[3]}, {c[0] for c in b[3]}
    return a[0] == b[0] and 2 * len(x & y) >= len(x | y) + bool(x ^ y)


def _folded(children: list) -> list:
    """Repeated neighbours as one element, repeated groups of kinds as their first round."""
    out: list = []
    for child in children:
        if out and _alike(out[-1], child):
            out[-1] = aligned(out[-1], child, repeated=True)
        else:
            out.append(child)
    for size in range(2, GROUP_ELEMENTS + 1):
        done: list = []
        for child in out:
            done.append(child)
            if len(done) >= 2 * size and all(_alike(done[-k], done[-k - size]) for k in range(1, size + 1)):
                last = done[-size:]
                del done[-size:]
                done[-size:] = [aligned(a, b, repeated=True) for a, b in zip(done[-size:], last, strict=True)]
        out = done
    return out


def _joined(a: list, b: list, one_page: bool) -> list:
    """The node of two nodes, without children."""
    values = [(a[4][0] + b[4][0]) % _MODULUS] if one_page else sorted({*a[4], *b[4]})[:LEAST_PAGES]
    return [a[0], a[1] | b[1], a[2] if a[2] == b[2] else None, [], values, a[5] + b[5]]


def aligned(a: list, b: list, repeated: bool = False) -> list:
    """The least wrapper that fits what a and b fit; both are of one kind, and of one page if ``repeated``."""
    root = _joined(a, b, repeated)
    root[1] |= 2 if repeated else 0
    todo = [(a, b, root)]
    while todo:
        x, y, node = todo.pop()
        for p, q in _matched(x[3], y[3]):
            if p is not None and q is not None:
                child = _joined(p, q, repeated)
                todo.append((p, q, child))
            else:
                only = q if p is None else p
                child = [only[0], only[1] | 1, *only[2:]]
            node[3].append(child)
    return root


def _matched(a: list, b: list):
    """Pairs of children of one kind in order, and single ones where the lists disagree.

    At a mismatch, the nearer of the next place of a's kind in b and of b's kind in a tells which list has something of its own.
    """
    places: tuple[dict[str, list[int]], dict[str, list[int]]] = ({}, {})
    if [x[0] for x in a] != [x[0] for x in b]:
        for side, nodes in zip(places, (a, b), strict=True):
            for k, node in enumerate(nodes):
                side.setdefault(node[0], []).append(k)

    def ahead(side: int, kind: str, at: int) -> float:
        own = places[side].get(kind, ())
        k = bisect_left(own, at)
        return own[k] - at if k < len(own) else float("inf")

    i = j = 0
    while i < len(a) or j < len(b):
        if i == len(a) or j == len(b):
            yield (a[i], None) if j == len(b) else (None, b[j])
            i, j = (i + 1, j) if j == len(b) else (i, j + 1)
        elif a[i][0] == b[j][0]:
            yield a[i], b[j]
            i, j = i + 1, j + 1
        elif (ahead(0, b[j][0], i), a[i][0]) < (ahead(1, a[i][0], j), b[j][0]):  # a has more here; ties by name
            yield a[i], None
            i += 1
        else:
            yield None, b[j]
            j += 1


def flat(wrapper: list) -> list[list]:
    """The nodes in page order, each with its depth in place of its children."""
    out, todo = [], [(wrapper, 0)]
    while todo:
        node, depth = todo.pop()
        out.append([depth, *node[:3], *node[4:]])
        todo.extend((c, depth + 1) for c in reversed(node[3]))
    return out


def unflat(rows: list[list]) -> list:
    path: list[list] = []
    for depth, kind, flags, text, values, chars in rows:
        node = [kind, flags, text, [], values, chars]
        del path[depth:]
        if path:
            path[-1][3].append(node)
        path.append(node)
    return path[0]


def expression(wrapper: list) -> str:
    """The wrapper as a regular expression without unions: #text is a slot, #same a long text, ? optional, + repeated."""
    out: list[str] = []
    todo: list = [wrapper]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        kind, flags, text, children = node[:4]
        slot = "#text" if text is None else entities.escape(text) if isinstance(text, str) else f"#same{text[0]}"
        end = (f"</{kind.split('.')[0]}>" if kind else "") + ({0: "", 1: ")?", 2: ")+", 3: ")*"}[flags])
        out.append(("(" if flags else "") + (f"<{kind}>{slot}" if kind else ""))
        todo.append(end)
        todo.extend(reversed(children))
    return "".join(out)


def rules_of(wrapper: list, pages: int) -> list[list]:
    """The template elements of a host's wrapper, with what leads to them: [depth, kind, digest of its texts or None] in page order."""
    if pages < LEAST_PAGES:
        return []
    nodes, parents, todo = [], [], [(wrapper, -1)]
    while todo:
        node, parent = todo.pop()
        nodes.append(node)
        parents.append(parent)
        at = len(nodes) - 1
        todo.extend((c, at) for c in reversed(node[3]))
    if sum(n[5] for n in nodes if len(n[4]) >= LEAST_PAGES) < VARYING_SHARE * sum(n[5] for n in nodes):
        return []
    varies, uniform, total = [len(n[4]) > 1 for n in nodes], [n[2] is not None for n in nodes], [n[4][0] for n in nodes]
    spelled = [0 if n[2] is None or n[2] == "" else _digest(n[2]) if isinstance(n[2], str) else n[2][1] for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        parent = parents[k]
        # What some pages lack counts as a difference.
        varies[parent] |= varies[k] or bool(nodes[k][1] & 1 and total[k])
        uniform[parent] &= uniform[k]
        total[parent] = (total[parent] + total[k]) % _MODULUS
        spelled[parent] = (spelled[parent] + spelled[k]) % _MODULUS
    # An element stands for all its repeats, so in one all must have one text.
    repeated, open_, depth = [False] * len(nodes), [True] * len(nodes), [0] * len(nodes)
    template: list[int | None] = [None] * len(nodes)
    for k in range(1, len(nodes)):
        parent = parents[k]
        depth[k], open_[k] = depth[parent] + 1, open_[parent] and varies[k]
        repeated[k] = repeated[parent] or bool(nodes[k][1] & 2)
        if open_[parent] and not varies[k] and not nodes[k][1] & 1 and total[k] and (not repeated[k] or uniform[k]):
            template[k] = spelled[k] if repeated[k] else total[k]
    leads = [t is not None for t in template]
    for k in range(len(nodes) - 1, 0, -1):
        leads[parents[k]] |= leads[k]
    return [[depth[k], nodes[k][0], template[k]] for k in range(1, len(nodes)) if leads[k]]


def template_tree(rules: list[list]) -> dict:
    """Rules as nested dicts: kind to (digests of template elements, dict of what is inside)."""
    root: dict = {}
    path = [root]
    for depth, kind, template in rules:
        del path[depth:]
        own = path[-1].setdefault(kind, (set(), {}))
        if template is not None:
            own[0].add(template)
        path.append(own[1])
    return root


def main_text(text: str, template: dict | None = None) -> str:
    """The main text of one page, by the rules of its host's wrapper (``template_tree``)."""
    page = Page(text)
    n = len(page.kinds)
    marked = any(page.main)
    holds = [m and (not page.main[page.parents[k]] or page.kinds[k].split(".")[0] in ("article", "main")) for k, m in enumerate(page.main)]
    for k in range(n - 1, 0, -1):
        holds[page.parents[k]] |= holds[k]
    keep, gone, inside = [False] * n, [False] * n, [None] * n
    inside[0] = template or None
    sums = page.sums() if template else []
    for k in range(n):
        if k:
            parent = page.parents[k]
            found = inside[parent].get(page.kinds[k]) if inside[parent] else None
            inside[k] = found[1] if found else None
            gone[k] = gone[parent] or bool(found and sums[k] in found[0] and not holds[k])
        keep[k] = (page.main[k] or not marked) and not page.left_out[k] and not gone[k]
    out = []
    for at, part in page.parts:
        if part is None:
            out.append(" ")
        elif keep[at]:
            out.append(entities.unescape(part))
        else:
            out.append(" ")
    return _SPACE.sub(" ", "".join(out)).strip()


def _fold(wrappers: list[tuple[str, int]]) -> tuple[str, int]:
    total, pages = None, 0
    for text, n in sorted(wrappers):
        wrapper = unflat(json.loads(text))
        total = wrapper if total is None else aligned(total, wrapper)
        pages += n
    return json.dumps(flat(total), ensure_ascii=False), pages


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper, pages): the wrapper of each host's pages, as the JSON of ``flat``."""

    def infer(batches):
        for batch in batches:
            found: dict[str, list] = {}
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tree = Page(text).tree()
                if host in found:
                    known = found[host]
                    found[host] = [aligned(known[0], tree), known[1] + 1]
                else:
                    found[host] = [tree, 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.string()),
                    pa.array([json.dumps(flat(w), ensure_ascii=False) for w, _ in found.values()], pa.string()),
                    pa.array([n for _, n in found.values()], pa.int64()),
                ],
                names=["host", "wrapper", "pages"],
            )

    def fold(table: pa.Table) -> pa.Table:
        text, n = _fold(list(zip(table.column("wrapper").to_pylist(), table.column("pages").to_pylist(), strict=True)))
        return pa.table({"host": table.column("host").slice(0, 1), "wrapper": pa.array([text], pa.string()), "pages": pa.array([n], pa.int64())})

    schema = "host string, wrapper string, pages long"
    read = pages.select(host_of(after_scheme(F.coalesce(F.col(url_col), F.lit("")))).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    partial = read.where("html != ''").mapInArrow(infer, schema)
    partial = share(partial.groupBy("host", "wrapper").agg(F.sum("pages").alias("pages")))
    while True:
        several = partial.df.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if several.isEmpty():
            return partial.df
        shares = F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / FOLDS).cast("long"))
        folded = partial.df.join(several, "host").groupBy("host", shares.alias("fold")).applyInArrow(fold, schema)
        folded = folded.groupBy("host", "wrapper").agg(F.sum("pages").alias("pages"))
        partial = share(partial.df.join(several, "host", "left_anti").unionByName(folded))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a page: id, url, text (its main text), n_chars."""

    def decide(batches):
        for batch in batches:
            rules = [rules_of(unflat(json.loads(w)), n) for w, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([json.dumps(r) for r in rules], pa.string())], names=["_host", "rules"])

    rules = share(wrappers(pages, url_col, html_col).mapInArrow(decide, "_host string, rules string")).df
    read = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        host_of(after_scheme(F.coalesce(F.col(url_col), F.lit("")))).alias("host"),
    )

    def extract(batches):
        known: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for text, rule in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if rule is not None and rule not in known:
                    if len(known) > 4096:
                        known.clear()
                    known[rule] = template_tree(json.loads(rule))
                texts.append(main_text(text, known.get(rule)) if text else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    joined = read.join(rules, read["host"] == rules["_host"], "left").select("id", "url", "html", "rules")
    return joined.mapInArrow(extract, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
