"""Text and number functions of the scores, as columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quillon import vocab as V


def py_round(x: Column, digits: int = 2) -> Column:
    """``round`` as Python does it: half to even, on the exact binary value.

    x * 10**digits is taken with its rounding error (Dekker's product), and the exact
    distance from the half decides.
    """
    scale = float(10**digits)
    high = 134217729.0 * x
    top = high - (high - x)
    low = x - top
    high_s = 134217729.0 * scale
    top_s = high_s - (high_s - scale)
    low_s = scale - top_s
    product = x * F.lit(scale)
    error = low * low_s - (((product - top * top_s) - low * top_s) - top * low_s)
    below = F.floor(product).cast("double")
    off = (product - below - 0.5) + error
    odd = F.pmod(below, F.lit(2.0)) == 1.0
    up = (off > 0) | ((off == 0) & odd)
    return (below + F.when(up, 1.0).otherwise(0.0)) / scale


def py_round_sql(x: str, digits: int = 2) -> str:
    """The same in SQL, for DuckDB."""
    s = float(10**digits)
    hs = 134217729.0 * s
    ts = hs - (hs - s)
    ls = s - ts
    x = f"CAST({x} AS DOUBLE)"
    big = "CAST(134217729 AS DOUBLE)"
    top = f"({big} * {x} - ({big} * {x} - {x}))"
    low = f"({x} - {top})"
    scale, t, low_s = (f"CAST({v!r} AS DOUBLE)" for v in (s, ts, ls))
    product = f"({x} * {scale})"
    error = f"({low} * {low_s} - ((({product} - {top} * {t}) - {low} * {t}) - {top} * {low_s}))"
    off = f"(({product} - floor({product}) - 0.5) + {error})"
    return f"((floor({product}) + CASE WHEN {off} > 0 OR ({off} = 0 AND floor({product}) % 2 = 1) THEN 1 ELSE 0 END) / {scale})"


def stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$", "")


def tokens(text: Column) -> Column:
    """Word tokens of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def adequacy(token_list: Column, min_tokens: int = V.MIN_TOKENS) -> Column:
    """0.4 * completeness + 0.6 * quality, within 0 and 1; 0 without tokens."""
    n = F.size(token_list).cast("double")
    stop = F.size(F.filter(token_list, lambda t: t.isin(*V.STOP_WORDS))).cast("double")
    value = 0.4 * F.least(F.lit(1.0), n / float(min_tokens)) + 0.6 * (1.0 - stop / F.nullif(n, F.lit(0.0)))
    return F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))).otherwise(0.0)


def local_name(iri: Column) -> Column:
    """After the last ``#``, else after the last ``/``."""
    return F.when(F.contains(iri, F.lit("#")), F.substring_index(iri, "#", -1)).otherwise(F.substring_index(iri, "/", -1))


def label_fragment(iri: Column) -> Column:
    """After the last ``#`` and then after the last ``/``: the label of an entity without one."""
    return F.substring_index(F.substring_index(iri, "#", -1), "/", -1)


def tail(value: Column) -> Column:
    """The last path segment, whatever slashes end the text."""
    return F.substring_index(F.regexp_replace(value, "/+$", ""), "/", -1)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; null if one is zero."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode NFKC, which Spark has no function for."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalised_query(text: Column) -> Column:
    """Lower case, NFKC, one space between words, trimmed."""
    return stripped(F.regexp_replace(nfkc(F.lower(F.coalesce(text, F.lit("")))), r"[\s\p{Z}]+", " "))


def js_round(x: Column, digits: int = 3) -> Column:
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / scale


def floor_double(x: Column) -> Column:
    """The floor as a double: Spark's is a long, which has no -0.0, NaN or infinity and ends at 2**63."""
    return F.when((x == 0) | (F.abs(x) >= 2.0**52), x).otherwise(F.floor(x).cast("double"))  # NaN counts as largest


def missing(x: Column) -> Column:
    """NaN becomes null."""
    return F.when(~F.isnan(x), x)


def python_float(x: Column) -> Column:
    """A double as Python spells it: its shortest digits, plain from 1e-4 up to 1e16, else with an exponent of two digits or more."""
    text, size = F.abs(x).cast("string"), F.abs(x)
    mantissa, power = F.substring_index(text, "E", 1), F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(0)
    whole, part = F.substring_index(mantissa, ".", 1), F.substring_index(mantissa, ".", -1)
    digits = F.concat(whole, F.when(part == "0", "").otherwise(part))
    places = F.length(whole) + power  # digits before the point
    plain = (
        F.when(places >= F.length(digits), F.concat(F.rpad(digits, places, "0"), F.lit(".0")))
        .when(places > 0, F.concat(F.substring(digits, F.lit(1), places), F.lit("."), F.substring(digits, places + 1, F.length(digits))))
        .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -places), digits))
    )
    strong = F.ltrim(digits, F.lit("0"))
    exponent = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    far = F.concat(F.substring(strong, 1, 1), F.when(F.length(strong) > 1, F.concat(F.lit("."), F.substring(strong, F.lit(2), F.length(strong)))).otherwise(""), F.lit("e"), exponent)
    # Java changes to an exponent at 1e7 and 1e-3, Python later, so a plain form of Java is one of Python.
    out = F.when(~F.contains(text, F.lit("E")), text).when((size >= 1e-4) & (size < 1e16), plain).otherwise(far)
    out = F.when(F.isnan(x), "nan").when(size == float("inf"), "inf").otherwise(out)
    return F.concat(F.when((x < 0) | (x.cast("string") == "-0.0"), "-").otherwise(""), out)


def sql_literal(x: Column, kind: str) -> Column:
    """A value as SQL text: NULL, 1 or 0, plain numbers, quoted strings."""
    if kind == "boolean":
        text = F.when(x, "1").otherwise("0")
    elif kind in ("double", "float"):
        return F.when(x.isNull() | F.isnan(x), "NULL").otherwise(python_float(x.cast("double")))
    elif kind in ("tinyint", "smallint", "int", "bigint"):
        text = x.cast("string")
    else:
        text = F.concat(F.lit("'"), F.replace(x.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    return F.when(x.isNull(), "NULL").otherwise(text)


def escaped_html(x: Column) -> Column:
    """HTML escaping of the five special characters; null gives an empty text."""
    out = F.coalesce(x, F.lit(""))
    for plain, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(plain), F.lit(ref))
    return out
