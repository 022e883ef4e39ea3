"""RDF parsers, and their fallback chain over whole files.

Each parser is a generator of (s, s_kind, p, o, o_kind, o_lang, o_dtype) over a text. ``parsed`` runs them on a table of
files in Arrow batches; a file that no parser reads becomes a row with its error, not a failed task.
"""

from __future__ import annotations

import json
import re
import time
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon import vocab as V
from quillon.sources import sniff

Triple = tuple[str, str, str, str, str, str | None, str | None]


class ParseError(ValueError):
    """A text is not of the format."""


_TOKEN = re.compile(
    r'\s+|#[^\n]*|(?P<iri><(?:[^\x00-\x20<>"{}|^`\\]|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})*>)'
    r'|(?P<long>"""(?:(?:"|"")?(?:[^"\\]|\\.))*"""|' r"'''(?:(?:'|'')?(?:[^'\\]|\\.))*''')"
    r'|(?P<string>"(?:[^"\\\n\r]|\\.)*"|' r"'(?:[^'\\\n\r]|\\.)*')"
    r"|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<dtype>\^\^)"
    r"|(?P<number>[+-]?(?:\d+\.\d*[eE][+-]?\d+|\.?\d+[eE][+-]?\d+|\d*\.\d+|\d+)(?![\w:]))"
    r"|(?P<bnode>_:[\w](?:[\w.\-·]*[\w\-·])?)"
    r"|(?P<name>(?:[^\W\d_](?:[\w.\-·]*[\w\-·])?)?:(?:(?:[\w:]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?#@%])(?:(?:[\w:.\-·]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?#@%])*(?:[\w:\-·]|%[0-9A-Fa-f]{2}|\\[_~.\-!$&'()*+,;=/?#@%]))?)?)"
    r"|(?P<word>[A-Za-z]+)|(?P<sign>=>|<=|[.;,\[\](){}=!^])",
    re.DOTALL,
)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.DOTALL)
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}


def _unescape(text: str) -> str:
    if "\\" not in text:
        return text
    return _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _PLAIN.get(m[1], m[1]), text)


class _Turtle:
    """Turtle, TriG (graph names are dropped) and the part of N3 that states facts."""

    def __init__(self, text: str, onto: str, base: str) -> None:
        self.tokens = self._split(text)
        self.at, self.onto, self.base = 0, onto, base
        self.prefixes: dict[str, str] = {}
        self.fresh = 0
        self.out: list[Triple] = []

    @staticmethod
    def _split(text: str) -> list[tuple[str, str]]:
        out, at = [], 0
        for m in iter(lambda: _TOKEN.match(text, at), None):
            at = m.end()
            if m.lastgroup:
                out.append((m.lastgroup, m[0]))
            if at == len(text):
                break
        if at != len(text):
            raise ParseError(f"unexpected text at {at}: {text[at : at + 30]!r}")
        return out

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, value: str | None = None) -> tuple[str, str]:
        token = self.peek()
        if token[0] == "end" or (value is not None and token[1] != value):
            raise ParseError(f"expected {value or 'more'}, found {token[1] or 'the end'}")
        self.at += 1
        return token

    def blank(self) -> tuple[str, str]:
        self.fresh += 1
        return f"{self.onto}#_:b{self.fresh}", "bnode"

    def iri(self, token: tuple[str, str]) -> str:
        kind, text = token
        if kind == "iri":
            return urljoin(self.base, _unescape(text[1:-1])) if self.base else _unescape(text[1:-1])
        if kind == "name":
            prefix, _, local = text.partition(":")
            if prefix not in self.prefixes:
                raise ParseError(f"unknown prefix {prefix}:")
            return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)
        raise ParseError(f"expected an IRI, found {text}")

    def run(self) -> list[Triple]:
        while self.peek()[0] != "end":
            self.statement()
        return self.out

    def statement(self) -> None:
        kind, text = self.peek()
        low = text.lower()
        if (kind == "lang" and low in ("@prefix", "@base")) or (kind == "word" and low in ("prefix", "base")):
            self.take()
            if low.endswith("prefix"):
                name = self.take()[1]
                self.prefixes[name[:-1]] = self.iri(self.take())
            else:
                self.base = self.iri(self.take())
            if kind == "lang":
                self.take(".")
            return
        if kind == "word" and low == "graph":
            self.take()
            self.take()
            self.block()
            return
        if text == "{":
            self.block()
            return
        subject = self.node()
        if self.peek()[1] == "{":
            self.block()
            return
        if not (subject[2] and self.peek()[1] in (".", "}")):
            self.predicates(subject[:2])
        if self.peek()[1] != "}":
            self.take(".")

    def block(self) -> None:
        self.take("{")
        while self.peek()[1] != "}":
            self.statement()
        self.take("}")
        if self.peek()[1] == ".":
            self.take()

    def predicates(self, subject: tuple[str, str]) -> None:
        while True:
            token = self.take()
            predicate = V.TYPE if token == ("word", "a") else V.OWL + "sameAs" if token[1] == "=" else self.iri(token)
            while True:
                self.add(subject, predicate, self.object())
                if self.peek()[1] != ",":
                    break
                self.take()
            while self.peek()[1] == ";":
                self.take()
                if self.peek()[1] not in (";", ".", "]", "}"):
                    break
            else:
                return
            if self.peek()[1] in (".", "]", "}"):
                return

    def add(self, subject: tuple[str, str], predicate: str, o: tuple) -> None:
        self.out.append((*subject, predicate, *o))

    def node(self) -> tuple[str, str, bool]:
        """(value, kind, whether it was a property list)."""
        kind, text = self.peek()
        if text == "[":
            self.take()
            node = self.blank()
            filled = self.peek()[1] != "]"
            if filled:
                self.predicates(node)
            self.take("]")
            return (*node, filled)
        if text == "(":
            return (*self.items(), False)
        self.take()
        if kind == "bnode":
            return f"{self.onto}#{text}", "bnode", False
        return self.iri((kind, text)), "iri", False

    def items(self) -> tuple[str, str]:
        self.take("(")
        head, last = (V.NIL, "iri"), None
        while self.peek()[1] != ")":
            value = self.object()
            cell = self.blank()
            if last is None:
                head = cell
            else:
                self.add(last, V.REST, (*cell, None, None))
            self.add(cell, V.FIRST, value)
            last = cell
        self.take(")")
        if last is not None:
            self.add(last, V.REST, (V.NIL, "iri", None, None))
        return head

    def object(self) -> tuple[str, str, str | None, str | None]:
        kind, text = self.peek()
        if kind in ("string", "long"):
            self.take()
            value = _unescape(text[3:-3] if kind == "long" else text[1:-1])
            follow = self.peek()
            if follow[0] == "lang":
                return value, "literal", self.take()[1][1:].lower(), None
            if follow[0] == "dtype":
                self.take()
                return value, "literal", None, self.iri(self.take())
            return value, "literal", None, None
        if kind == "number":
            self.take()
            name = "double" if "e" in text.lower() else "decimal" if "." in text else "integer"
            return text, "literal", None, V.XSD + name
        if kind == "word" and text in ("true", "false"):
            self.take()
            return text, "literal", None, V.XSD + "boolean"
        node = self.node()
        return node[0], node[1], None, None


def turtle(text: str, onto: str, base: str = "") -> Iterator[Triple]:
    yield from _Turtle(text, onto, base).run()


_NT = re.compile(r'(?:<([^<>]*)>|_:(\S+))\s*<([^<>]*)>\s*(?:<([^<>]*)>|_:([^\s]+?)|"((?:[^"\\]|\\.)*)"(?:@([\w-]+)|\^\^<([^<>]*)>)?)\s*(?:<[^<>]*>\s*)?\.\s*(?:#.*)?$')


def ntriples(text: str, onto: str, base: str = "") -> Iterator[Triple]:
    """N-Triples, and N-Quads without their graph names; for large files use quillon.sources.ntriples."""
    for k, line in enumerate(text.splitlines()):
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        m = _NT.match(line)
        if not m:
            raise ParseError(f"line {k + 1}: {line[:60]!r}")
        s = (_unescape(m[1]), "iri") if m[1] is not None else (f"{onto}#_:{m[2]}", "bnode")
        if m[4] is not None:
            o = (_unescape(m[4]), "iri", None, None)
        elif m[5] is not None:
            o = (f"{onto}#_:{m[5]}", "bnode", None, None)
        else:
            o = (_unescape(m[6]), "literal", m[7].lower() if m[7] else None, m[8])
        yield (*s, _unescape(m[3]), *o)


def _tree(text: str) -> ET.Element:
    try:
        return ET.fromstring(text)
    except ET.ParseError as error:
        raise ParseError(str(error)) from None


def _name(tag: str) -> str:
    return tag[1:].replace("}", "", 1) if tag.startswith("{") else tag


class _RdfXml:
    def __init__(self, onto: str, base: str) -> None:
        self.onto, self.base0, self.fresh, self.out = onto, base, 0, []

    def blank(self, name: str | None = None) -> tuple[str, str]:
        if name is None:
            self.fresh += 1
            name = f"x{self.fresh}"
        return f"{self.onto}#_:{name}", "bnode"

    def subject(self, e: ET.Element, base: str) -> tuple[str, str]:
        about, rid, node = (e.get(f"{{{V.RDF}}}{k}") for k in ("about", "ID", "nodeID"))
        if about is not None:
            return urljoin(base, about) if base else about, "iri"
        if rid is not None:
            return f"{base}#{rid}", "iri"
        return self.blank(node)

    def element(self, e: ET.Element, base: str, lang: str | None) -> tuple[str, str]:
        base, lang = e.get(f"{{{V.XML}}}base", base), e.get(f"{{{V.XML}}}lang", lang)
        me = self.subject(e, base)
        kind = _name(e.tag)
        if kind != V.RDF + "Description":
            self.out.append((*me, V.TYPE, kind, "iri", None, None))
        for key, value in e.attrib.items():
            name = _name(key)
            if name == V.TYPE:
                self.out.append((*me, V.TYPE, urljoin(base, value), "iri", None, None))
            elif not name.startswith((V.RDF, V.XML)) and ":" in name:
                self.out.append((*me, name, value, "literal", lang.lower() if lang else None, None))
        count = 0
        for child in e:
            if not isinstance(child.tag, str):
                continue
            name = _name(child.tag)
            if name == V.RDF + "li":
                count += 1
                name = f"{V.RDF}_{count}"
            self.prop(me, name, child, base, lang)
        return me

    def prop(self, me: tuple[str, str], name: str, e: ET.Element, base: str, lang: str | None) -> None:
        base, lang = e.get(f"{{{V.XML}}}base", base), e.get(f"{{{V.XML}}}lang", lang)
        get = lambda k: e.get(f"{{{V.RDF}}}{k}")
        kind, resource, node = get("parseType"), get("resource"), get("nodeID")
        children = [c for c in e if isinstance(c.tag, str)]
        if kind == "Literal":
            value = (e.text or "") + "".join(ET.tostring(c, encoding="unicode") for c in e)
            o = (value, "literal", None, V.RDF + "XMLLiteral")
        elif kind == "Collection":
            cells = [self.blank() for _ in children]
            for k, child in enumerate(children):
                item = self.element(child, base, lang)
                self.out.append((*cells[k], V.FIRST, *item, None, None))
                following = cells[k + 1] if k + 1 < len(cells) else (V.NIL, "iri")
                self.out.append((*cells[k], V.REST, *following, None, None))
            o = (*(cells[0] if cells else (V.NIL, "iri")), None, None)
        elif kind == "Resource":
            inner = self.blank()
            for child in children:
                self.prop(inner, _name(child.tag), child, base, lang)
            o = (*inner, None, None)
        elif resource is not None:
            o = (urljoin(base, resource) if base else resource, "iri", None, None)
        elif node is not None:
            o = (*self.blank(node), None, None)
        elif children:
            o = (*self.element(children[0], base, lang), None, None)
        else:
            extra = [(k, v) for k, v in ((_name(k), v) for k, v in e.attrib.items()) if not k.startswith((V.RDF, V.XML))]
            if extra:
                inner = self.blank()
                self.out += [(*inner, k, v, "literal", lang.lower() if lang else None, None) for k, v in extra]
                o = (*inner, None, None)
            else:
                dtype = get("datatype")
                o = (e.text or "", "literal", lang.lower() if lang and not dtype else None, dtype)
        self.out.append((*me, name, *o))
        rid = get("ID")
        if rid is not None:
            statement = (f"{base}#{rid}", "iri")
            self.out += [
                (*statement, V.TYPE, V.RDF + "Statement", "iri", None, None), (*statement, V.RDF + "subject", *me, None, None),
                (*statement, V.RDF + "predicate", name, "iri", None, None), (*statement, V.RDF + "object", *o),
            ]


def rdfxml(text: str, onto: str, base: str = "") -> Iterator[Triple]:
    root = _tree(text)
    reader = _RdfXml(onto, base)
    base, lang = root.get(f"{{{V.XML}}}base", base), root.get(f"{{{V.XML}}}lang")
    if _name(root.tag) == V.RDF + "RDF":
        for child in root:
            if isinstance(child.tag, str):
                reader.element(child, base, lang)
    elif root.tag.startswith("{") and not root.tag.startswith(("{" + V.OWL + "}", "{http://www.w3.org/2004/03/trix")):
        reader.element(root, base, lang)
    else:
        raise ParseError(f"no RDF element: {root.tag}")
    yield from reader.out


def trix(text: str, onto: str, base: str = "") -> Iterator[Triple]:
    root = _tree(text)
    if not root.tag.lower().endswith("trix"):
        raise ParseError(f"no TriX element: {root.tag}")

    def term(e: ET.Element) -> tuple[str, str, str | None, str | None]:
        kind, value = e.tag.rpartition("}")[2], (e.text or "")
        if kind == "uri":
            return value.strip(), "iri", None, None
        if kind == "id":
            return f"{onto}#_:{value.strip()}", "bnode", None, None
        lang = e.get(f"{{{V.XML}}}lang")
        return value, "literal", lang.lower() if lang else None, e.get("datatype")

    for triple in root.iter():
        if isinstance(triple.tag, str) and triple.tag.rpartition("}")[2] == "triple":
            s, p, o = (term(x) for x in triple)
            yield (s[0], s[1], p[0], *o)


def owlxml(text: str, onto: str, base: str = "") -> Iterator[Triple]:
    """The axioms of OWL/XML that the scores read: declarations, class axioms and expressions, assertions, annotations."""
    root = _tree(text)
    if _name(root.tag) != V.OWL + "Ontology":
        raise ParseError(f"no Ontology element: {root.tag}")
    base = root.get(f"{{{V.XML}}}base", base)
    prefixes = {e.get("name"): e.get("IRI") for e in root if _name(e.tag) == V.OWL + "Prefix"}
    fresh = [0]
    out: list[Triple] = []
    kinds = {"Class": "Class", "NamedIndividual": "NamedIndividual", "ObjectProperty": "ObjectProperty", "DataProperty": "DatatypeProperty", "AnnotationProperty": "AnnotationProperty", "Datatype": "Datatype"}

    def blank() -> tuple[str, str, None, None]:
        fresh[0] += 1
        return f"{onto}#_:o{fresh[0]}", "bnode", None, None

    def named(e: ET.Element) -> str:
        if e.get("abbreviatedIRI") is not None:
            prefix, _, local = e.get("abbreviatedIRI").partition(":")
            return (prefixes.get(prefix) or "") + local
        iri = e.get("IRI") or ""
        return base + iri if iri.startswith("#") else urljoin(base, iri) if base else iri

    def kind_of(e: ET.Element) -> str:
        return _name(e.tag).removeprefix(V.OWL)

    def listed(items: list) -> tuple:
        cells = [blank() for _ in items]
        for k, item in enumerate(items):
            out.append((*cells[k][:2], V.FIRST, *item))
            out.append((*cells[k][:2], V.REST, *(cells[k + 1] if k + 1 < len(cells) else (V.NIL, "iri", None, None))))
        return cells[0] if cells else (V.NIL, "iri", None, None)

    def value(e: ET.Element) -> tuple[str, str, str | None, str | None]:
        kind = kind_of(e)
        if kind in kinds or e.get("IRI") is not None or e.get("abbreviatedIRI") is not None:
            return named(e), "iri", None, None
        if kind == "IRI":
            text = (e.text or "").strip()
            return base + text if text.startswith("#") else text, "iri", None, None
        if kind == "AbbreviatedIRI":
            prefix, _, local = (e.text or "").strip().partition(":")
            return (prefixes.get(prefix) or "") + local, "iri", None, None
        if kind == "AnonymousIndividual":
            return f"{onto}#_:{e.get('nodeID')}", "bnode", None, None
        if kind == "Literal":
            lang = e.get(f"{{{V.XML}}}lang")
            return e.text or "", "literal", lang.lower() if lang else None, e.get("datatypeIRI")
        node = blank()
        parts = [c for c in e if isinstance(c.tag, str)]
        restrictions = {"ObjectSomeValuesFrom": "someValuesFrom", "DataSomeValuesFrom": "someValuesFrom", "ObjectAllValuesFrom": "allValuesFrom", "DataAllValuesFrom": "allValuesFrom", "ObjectHasValue": "hasValue", "DataHasValue": "hasValue"}
        lists = {"ObjectIntersectionOf": "intersectionOf", "ObjectUnionOf": "unionOf", "ObjectOneOf": "oneOf"}
        if kind in restrictions and len(parts) == 2:
            out.append((*node[:2], V.TYPE, V.RESTRICTION, "iri", None, None))
            out.append((*node[:2], V.ON_PROPERTY, *value(parts[0])))
            out.append((*node[:2], V.OWL + restrictions[kind], *value(parts[1])))
        elif kind in lists:
            out.append((*node[:2], V.TYPE, V.OWL + "Class", "iri", None, None))
            out.append((*node[:2], V.OWL + lists[kind], *listed([value(p) for p in parts])))
        elif kind == "ObjectComplementOf":
            out.append((*node[:2], V.OWL + "complementOf", *value(parts[0])))
        elif kind == "ObjectInverseOf":
            out.append((*node[:2], V.OWL + "inverseOf", *value(parts[0])))
        elif re.fullmatch(r"(Object|Data)(Min|Max|Exact)Cardinality", kind):
            name = kind.replace("Object", "").replace("Data", "")
            name = {"Min": "minCardinality", "Max": "maxCardinality", "Exa": "cardinality"}[name[:3]]
            out.append((*node[:2], V.TYPE, V.RESTRICTION, "iri", None, None))
            out.append((*node[:2], V.ON_PROPERTY, *value(parts[0])))
            if len(parts) > 1:
                name = "qualifiedCardinality" if name == "cardinality" else name[:3] + "QualifiedCardinality"
                out.append((*node[:2], V.OWL + "onClass", *value(parts[1])))
            out.append((*node[:2], V.OWL + name, e.get("cardinality") or "", "literal", None, V.XSD + "nonNegativeInteger"))
        return node

    me = root.get("ontologyIRI")
    ontology = (me, "iri") if me else blank()[:2]
    out.append((*ontology, V.TYPE, V.ONTOLOGY, "iri", None, None))
    if root.get("versionIRI"):
        out.append((*ontology, V.VERSION, root.get("versionIRI"), "iri", None, None))
    plain = {
        "SubClassOf": V.SUBCLASS, "SubObjectPropertyOf": V.RDFS + "subPropertyOf", "SubDataPropertyOf": V.RDFS + "subPropertyOf", "SubAnnotationPropertyOf": V.RDFS + "subPropertyOf",
        "ObjectPropertyDomain": V.RDFS + "domain", "DataPropertyDomain": V.RDFS + "domain", "ObjectPropertyRange": V.RDFS + "range", "DataPropertyRange": V.RDFS + "range",
        "InverseObjectProperties": V.OWL + "inverseOf",
    }
    chained = {"EquivalentClasses": V.EQUIVALENT, "EquivalentObjectProperties": V.OWL + "equivalentProperty", "DisjointClasses": V.OWL + "disjointWith", "SameIndividual": V.OWL + "sameAs", "DifferentIndividuals": V.OWL + "differentFrom"}
    for axiom in root:
        if not isinstance(axiom.tag, str):
            continue
        kind = kind_of(axiom)
        parts = [c for c in axiom if isinstance(c.tag, str) and kind_of(c) != "Annotation"]
        if kind == "Import":
            out.append((*ontology, V.IMPORTS, (axiom.text or "").strip(), "iri", None, None))
        elif kind == "Annotation" and len(parts) == 2:
            out.append((*ontology, value(parts[0])[0], *value(parts[1])))
        elif kind == "Declaration" and parts:
            out.append((named(parts[0]), "iri", V.TYPE, V.OWL + kinds.get(kind_of(parts[0]), kind_of(parts[0])), "iri", None, None))
        elif kind in plain and len(parts) == 2:
            s = value(parts[0])
            out.append((*s[:2], plain[kind], *value(parts[1])))
        elif kind in chained and len(parts) >= 2:
            values = [value(p) for p in parts]
            out += [(*values[0][:2], chained[kind], *v) for v in values[1:]]
        elif kind == "ClassAssertion" and len(parts) == 2:
            c = value(parts[0])
            out.append((*value(parts[1])[:2], V.TYPE, *c))
        elif kind in ("ObjectPropertyAssertion", "DataPropertyAssertion", "AnnotationAssertion") and len(parts) == 3:
            p, s, o = (value(x) for x in parts)
            out.append((*s[:2], p[0], *o))
    yield from out


def jsonld(text: str, onto: str, base: str = "") -> Iterator[Triple]:
    """Expanded or compacted JSON-LD with an inline context; remote contexts are not fetched."""
    try:
        document = json.loads(text)
    except ValueError as error:
        raise ParseError(str(error)) from None
    fresh = [0]
    out: list[Triple] = []

    def expand(name: str, context: dict) -> str:
        if name.startswith("_:") or name.startswith("@"):
            return name
        known = context.get(name)
        if isinstance(known, dict):
            known = known.get("@id", name)
        if isinstance(known, str) and known != name:
            return expand(known, context)
        prefix, colon, local = name.partition(":")
        if colon and not local.startswith("//") and isinstance(context.get(prefix), str):
            return context[prefix] + local
        return name if colon else context.get("@vocab", "") + name

    def node(value: dict, context: dict) -> tuple[str, str]:
        rid = value.get("@id")
        if rid is None or rid.startswith("_:"):
            fresh[0] += rid is None
            me = (f"{onto}#_:j{fresh[0]}" if rid is None else f"{onto}#{rid}", "bnode")
        else:
            me = (urljoin(context.get("@base", base), expand(rid, context) if ":" in rid else rid), "iri")
        walk(value, me, context)
        return me

    def term(value, context: dict, hint: dict):
        if isinstance(value, dict):
            if "@value" in value:
                v = value["@value"]
                dtype = value.get("@type")
                text = json.dumps(v) if isinstance(v, (bool, int, float)) else str(v)
                lang = value.get("@language")
                return text, "literal", lang.lower() if lang else None, expand(dtype, context) if dtype else None
            if "@list" in value:
                items = [term(x, context, hint) for x in value["@list"]]
                head: tuple = (V.NIL, "iri")
                for item in reversed(items):
                    fresh[0] += 1
                    cell = (f"{onto}#_:j{fresh[0]}", "bnode")
                    out.append((*cell, V.FIRST, *item))
                    out.append((*cell, V.REST, *head, None, None))
                    head = cell
                return (*head, None, None)
            return (*node(value, context), None, None)
        if hint.get("@type") in ("@id", "@vocab") and isinstance(value, str):
            return (f"{onto}#{value}", "bnode", None, None) if value.startswith("_:") else (urljoin(context.get("@base", base), expand(value, context) if ":" in value else value), "iri", None, None)
        kind = "boolean" if isinstance(value, bool) else "integer" if isinstance(value, int) else "double" if isinstance(value, float) else None
        lang = hint.get("@language", context.get("@language")) if kind is None else None
        dtype = V.XSD + kind if kind else expand(hint["@type"], context) if hint.get("@type") else None
        return (json.dumps(value) if kind else str(value)), "literal", lang.lower() if lang and not dtype else None, dtype

    def walk(value: dict, me: tuple[str, str], context: dict) -> None:
        for key, content in value.items():
            if key == "@type":
                for t in content if isinstance(content, list) else [content]:
                    out.append((*me, V.TYPE, expand(t, context), "iri", None, None))
            elif key == "@graph":
                for x in content if isinstance(content, list) else [content]:
                    node(x, context)
            elif not key.startswith("@"):
                name = expand(key, context)
                if ":" not in name:
                    continue
                hint = context.get(key) if isinstance(context.get(key), dict) else {}
                if hint.get("@container") == "@list" and isinstance(content, list):
                    content = [{"@list": content}]
                for x in content if isinstance(content, list) else [content]:
                    if x is not None:
                        out.append((*me, name, *term(x, context, hint)))

    for top in document if isinstance(document, list) else [document]:
        if not isinstance(top, dict):
            raise ParseError("no JSON-LD object")
        context: dict = {}
        for c in top.get("@context") if isinstance(top.get("@context"), list) else [top.get("@context")]:
            if isinstance(c, dict):
                context |= c
            elif isinstance(c, str):
                raise ParseError(f"remote context {c}")
        if "@graph" in top and set(top) <= {"@context", "@graph", "@id"}:
            for x in top["@graph"]:
                node(x, context)
        else:
            node(top, context)
    yield from out


PARSERS = {"xml": rdfxml, "turtle": turtle, "n3": turtle, "nt": ntriples, "trig": turtle, "trix": trix, "json-ld": jsonld, "owlxml": owlxml}
ORDER = ("xml", "turtle", "n3", "nt", "trig", "trix")


def parse(text: str, onto: str, first: str | None = None, base: str = "") -> tuple[list[Triple] | None, str | None, list[dict]]:
    """(triples, format, attempts): the first parser that reads the text; the sniffed format first, then the others."""
    if first == "owlxml":
        order = ["owlxml"]
    else:
        order = list(dict.fromkeys([*([first] if first in PARSERS else []), *ORDER]))
    attempts = []
    for name in order:
        began = time.perf_counter()
        try:
            found = list(dict.fromkeys(PARSERS[name](text, onto, base)))
            if not found and text.strip() and name != first:
                raise ParseError("no triples")
            attempts.append({"format": name, "ok": True, "seconds": round(time.perf_counter() - began, 3), "error": None})
            return found, name, attempts
        except (ParseError, KeyError, TypeError, AttributeError, RecursionError) as error:
            attempts.append({"format": name, "ok": False, "seconds": round(time.perf_counter() - began, 3), "error": f"{type(error).__name__}: {str(error)[:300]}"})
    return None, None, attempts


def parsed(files: DataFrame) -> DataFrame:
    """Files (onto_id, content) to (onto_id, sniffed_format, format, error, attempts, triples): one row a file.

    Formats that are not read are told by their error before parsing. A file is the unit of work; very large ontologies should come as
    N-Triples, which quillon.sources.ntriples splits.
    """
    attempt = pa.list_(pa.struct([("format", pa.string()), ("ok", pa.bool_()), ("seconds", pa.float64()), ("error", pa.string())]))
    names = ["s", "s_kind", "p", "o", "o_kind", "o_lang", "o_dtype"]

    def run(batches):
        for batch in batches:
            # A file at a time, its triples as columns, so a task never holds the triples of two.
            for k in range(batch.num_rows):
                onto, content, kind, error = (c[k].as_py() for c in batch.columns)
                found, name, attempts = (None, None, [])
                if error is None:
                    found, name, attempts = parse((content or b"").decode("utf-8-sig", errors="replace"), onto, kind)
                    if found is None:
                        error = "unsupported format (tried " + ", ".join(a["format"] for a in attempts) + f"). Last error: {attempts[-1]['error']}"
                columns = [pa.array([t[i] for t in found or []], pa.string()) for i in range(len(names))]
                items = pa.ListArray.from_arrays(pa.array([0, len(found or [])], pa.int32()), pa.StructArray.from_arrays(columns, names=names))
                one = [pa.array([v], kind_) for v, kind_ in ((onto, batch.column(0).type), (kind, pa.string()), (name, pa.string()), (error, pa.string()), (attempts, attempt))]
                yield pa.RecordBatch.from_arrays([*one, items], names=["onto_id", "sniffed_format", "format", "error", "attempts", "triples"])

    told = files.select("onto_id", "content", sniff.sniffed(F.col("content")).alias("kind"))
    told = told.withColumn("error", sniff.unsupported(F.col("kind")))
    fields = ", ".join(f"{n}: string" for n in names)
    return told.mapInArrow(
        run, f"onto_id string, sniffed_format string, format string, error string, attempts array<struct<format: string, ok: boolean, seconds: double, error: string>>, triples array<struct<{fields}>>"
    )


def triples(parsed_files: DataFrame) -> DataFrame:
    """The triples of parsed files (see quillon.schemas)."""
    return parsed_files.select("onto_id", F.explode("triples").alias("t")).select("onto_id", "t.*")


def failures(parsed_files: DataFrame) -> DataFrame:
    return parsed_files.where("error IS NOT NULL").select("onto_id", "sniffed_format", "error", "attempts")
