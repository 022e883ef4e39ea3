"""N-Triples, read natively: one line of text, one triple."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LINE = r'^\s*(?:<([^<>"{}|^`\\\x00-\x20]*(?:\\u[0-9A-Fa-f]{4}[^<>]*)?)>|_:([^\s<>"]+))\s*<([^<>\s]*)>\s*(?:<([^<>\s]*)>|_:([^\s<>".]+(?:\.[^\s<>".]+)*)|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z]+(?:-[A-Za-z0-9]+)*)|\^\^<([^<>\s]*)>)?)\s*\.\s*(?:#.*)?$'


def unescaped(x: Column) -> Column:
    """Escapes of strings and IRIs: \\t \\b \\n \\r \\f \\" \\' \\\\ \\uXXXX \\UXXXXXXXX."""
    parts = F.regexp_extract_all(x, F.lit(r"(?s)(\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+)"), F.lit(1))
    plain = {"\\t": "\t", "\\b": "\b", "\\n": "\n", "\\r": "\r", "\\f": "\f", '\\"': '"', "\\'": "'", "\\\\": "\\"}

    def one(p: Column) -> Column:
        # A code point as UTF-32 bytes, decoded.
        code = F.when(p.startswith("\\u"), F.concat(F.lit("0000"), F.substring(p, 3, 4))).when(p.startswith("\\U"), F.substring(p, 3, 8))
        out = F.when(code.isNotNull(), F.decode(F.unhex(code), "UTF-32"))
        for escape, char in plain.items():
            out = out.when(p == escape, char)
        return out.otherwise(p)

    return F.when(F.contains(x, F.lit("\\")), F.array_join(F.transform(parts, one), "")).otherwise(x)


def parsed_lines(lines: DataFrame, onto: Column | str = "onto_id", line: str = "value") -> DataFrame:
    """Triples of lines (see quillon.schemas); blank lines and comments give none. A line that is neither has ``s`` null."""
    text = F.col(line)
    some = lines.where(~text.rlike(r"^\s*(#.*)?$"))
    part = lambda k: F.nullif(F.regexp_extract(text, _LINE, k), F.lit(""))
    key = F.col(onto) if isinstance(onto, str) else onto
    ok = text.rlike(_LINE)
    is_literal = part(4).isNull() & part(5).isNull()
    local = lambda k: F.concat(key, F.lit("#_:"), part(k))
    return some.select(
        key.alias("onto_id"),
        F.when(ok, F.coalesce(unescaped(part(1)), local(2))).alias("s"), F.when(ok, F.when(part(2).isNull(), "iri").otherwise("bnode")).alias("s_kind"),
        F.when(ok, unescaped(part(3))).alias("p"),
        F.when(ok, F.when(is_literal, unescaped(F.regexp_extract(text, _LINE, 6))).otherwise(F.coalesce(unescaped(part(4)), local(5)))).alias("o"),
        F.when(ok, F.when(is_literal, "literal").when(part(4).isNull(), "bnode").otherwise("iri")).alias("o_kind"),
        F.when(ok & is_literal, F.lower(part(7))).alias("o_lang"), F.when(ok & is_literal, part(8)).alias("o_dtype"),
    )


def read(spark, path: str, onto: str) -> DataFrame:
    """The triples of N-Triples files; the files can be of any size, as lines are split over tasks."""
    return parsed_lines(spark.read.text(path).withColumn("onto_id", F.lit(onto))).where("s IS NOT NULL")
