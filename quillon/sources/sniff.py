"""Format detection from the first bytes of a file, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD_BYTES = 65_536
UNSUPPORTED = ("obo", "ofn", "omn", "zip", "gzip", "empty")
NOT_ONTOLOGY = ("html", "office_document")


def sniffed(content: Column, members: Column | None = None) -> Column:
    """The format of a binary column, or null; ``members`` are an archive's file names, where known. The order of the rules counts."""
    head = F.substring(content, 1, HEAD_BYTES)
    raw = F.try_validate_utf8(head)
    # A letter may be cut at the end of the head; then the bytes are read one by one.
    text = F.coalesce(raw, F.decode(head, "ISO-8859-1"))
    text = F.regexp_replace(F.regexp_replace(text, "^(﻿|ï»¿)", ""), r"^\s+", "")
    low = F.lower(text)
    lines = F.slice(F.filter(F.transform(F.slice(F.split(low, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), 1, 200), F.trim), lambda x: (x != "") & ~x.startswith("#")), 1, 50)
    first = F.try_element_at(lines, F.lit(1))
    some = F.size(lines) > 0
    magic = F.hex(F.substring(content, 1, 2))
    office = F.lit(False) if members is None else F.coalesce(F.array_contains(members, "[Content_Types].xml"), F.lit(False))
    return (
        F.when(F.length(text) == 0, "empty")
        .when((magic == "504B") & office, "office_document")
        .when(magic == "504B", "zip")
        .when(magic == "1F8B", "gzip")
        .when(F.contains(low, F.lit("<rdf:rdf")), "xml")
        .when(low.startswith("<!doctype html") | low.startswith("<html"), "html")
        .when(F.contains(low, F.lit("<ontology")) & F.contains(low, F.lit("www.w3.org/2002/07/owl")), "owlxml")
        .when(low.startswith("<?xml") & F.contains(low, F.lit("<trix")), "trix")
        .when(low.startswith("<?xml"), "xml")
        .when(low.startswith("format-version:") | F.contains(low, F.lit("\n[term]")) | low.startswith("[term]"), "obo")
        .when(some & (first.startswith("prefix(") | first.startswith("ontology(")), "ofn")
        .when(some & (first.startswith("prefix:") | first.startswith("ontology:")), "omn")
        .when(low.startswith("{") | low.startswith("["), "json-ld")
        .when(F.exists(lines, lambda x: x.startswith("@prefix") | x.startswith("@base") | x.startswith("prefix ") | x.startswith("base ")), "turtle")
        .when(some & F.forall(F.slice(lines, 1, 20), lambda x: (x.startswith("<") | x.startswith("_:")) & x.endswith(".")), "nt")
    )


def unsupported(kind: Column) -> Column:
    """The parse error of formats that are not read, else null."""
    return F.when(kind.isin(*NOT_ONTOLOGY), F.concat(F.lit("not_an_ontology:"), kind)).when(kind.isin(*UNSUPPORTED), F.concat(F.lit("unsupported_format:"), kind))
