"""Files of submissions: server names, archives and the member to read."""

from __future__ import annotations

import gzip
import io
import zipfile
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.sources import sniff

# Endings of ontology files, of which the largest member of an archive is taken, and how many members are listed.
ENDINGS = (".owl", ".rdf", ".ttl", ".xml", ".nt", ".n3", ".jsonld", ".trig", ".obo")
LISTED = 500
#: A larger file is not unpacked into a row, which holds less than 2 GiB; it gets the error too_large.
MOST_BYTES = 1 << 30


def server_filename(disposition: Column) -> Column:
    """The file name of a Content-Disposition header, or null.

    A parameter is a token, ``=`` and a token or quoted text (backslash escapes a sign). The extended form, charset'language'text
    with per cent escapes, comes before the plain one; escapes of a charset other than UTF-8 and US-ASCII stay as they are.
    """
    header, begin = F.coalesce(disposition, F.lit("")), r"(?i)(?:^|[;\s])filename"
    extended = F.regexp_extract(header, begin + r"\*\s*=\s*([\w!#$%&+^`{}~-]*)'[^']*'([^;\s]+)", 2)
    charset = F.lower(F.regexp_extract(header, begin + r"\*\s*=\s*([\w!#$%&+^`{}~-]*)'", 1))
    decoded = F.when(charset.isin("utf-8", "us-ascii"), F.coalesce(F.try_url_decode(F.replace(extended, F.lit("+"), F.lit("%2B"))), extended)).otherwise(extended)
    quoted = F.regexp_replace(F.regexp_extract(header, begin + r'\s*=\s*"((?:[^"\\]|\\.)*)"', 1), r"\\(.)", "$1")
    token = F.regexp_extract(header, begin + r'\*?\s*=\s*([^\s;"]+)', 1)
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (decoded, quoted, token)])


def choose_member(members: list[tuple[str, int]], master: str | None) -> str | None:
    """The member with the master's base name, else the largest with an ontology ending, else the largest."""
    if master:
        for name, _ in members:
            if name.rsplit("/", 1)[-1] == master:
                return name
    some = [m for m in members if m[0].lower().endswith(ENDINGS)] or members
    return max(some, key=lambda m: m[1], default=(None, 0))[0]


def _opened(content: bytes, master: str | None) -> tuple[bytes, str | None, list[str] | None, str | None]:
    """(bytes to read, archive type, members, error)."""
    if content[:2] == b"PK":
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                members = [(m.filename, m.file_size) for m in archive.infolist() if not m.is_dir()]
                names = [n for n, _ in members]
                if "[Content_Types].xml" in names:
                    return content, "office_document", names[:LISTED], None
                pick = choose_member(members, master)
                if pick is None:
                    return b"", "zip", [], None
                if dict(members)[pick] > MOST_BYTES:
                    return b"", "zip", names[:LISTED], "too_large"
                return archive.read(pick), "zip", names[:LISTED], None
        except (zipfile.BadZipFile, RuntimeError, NotImplementedError, zlib.error) as error:
            return content, "zip", None, f"{type(error).__name__}: {error}"
    if content[:2] == b"\x1f\x8b":
        try:
            with gzip.open(io.BytesIO(content)) as stream:
                data = stream.read(MOST_BYTES + 1)
            return (b"", "gzip", None, "too_large") if len(data) > MOST_BYTES else (data, "gzip", None, None)
        except (OSError, EOFError, zlib.error) as error:
            return content, "gzip", None, f"{type(error).__name__}: {error}"
    return content, None, None, None


def expanded(files: DataFrame, key: str = "onto_id") -> DataFrame:
    """Files (key, content, master) to (key, content, archive_type, archive_members, archive_error, sniffed_format)."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # a file at a time, so a task never holds two opened ones
                content, kind, members, error = _opened(batch.column(1)[k].as_py() or b"", batch.column(2)[k].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, 1), pa.array([content], pa.binary()), pa.array([kind], pa.string()), pa.array([members], pa.list_(pa.string())), pa.array([error], pa.string())],
                    names=[key, "content", "archive_type", "archive_members", "archive_error"],
                )

    kind = files.schema[key].dataType.simpleString()
    out = files.select(key, "content", "master").mapInArrow(run, f"{key} {kind}, content binary, archive_type string, archive_members array<string>, archive_error string")
    format_ = F.when(F.col("archive_type") == "office_document", "office_document").otherwise(sniff.sniffed(F.col("content")))
    return out.withColumn("sniffed_format", format_)


def read_files(spark, path: str) -> DataFrame:
    """Landed files as (onto_id, content, sha256, bytes); onto_id is the file's name."""
    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return files.select(name.alias("onto_id"), "content", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
