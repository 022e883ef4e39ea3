"""The registry's REST interface: a throttled client with retries, and what lands from it.

The listing is asked for on the driver: the registry allows a few requests a second. Files are fetched in tasks that share that
rate, so their bytes never pass the driver.
``send`` is any function (url, params, headers) -> (status, headers, body), so tests need no network.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon import schemas
from quillon.sources.archives import MOST_BYTES

Send = Callable[[str, dict, dict], tuple[int, dict, bytes]]


class AuthError(RuntimeError):
    """The key was refused."""


@dataclass
class Client:
    """At most ``per_second`` requests; 429, 5xx and network errors are tried again, waiting as told or twice as long each time."""

    send: Send
    base: str
    key: str = ""
    per_second: float = 8.0
    retries: int = 4
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _last: float = field(default=float("-inf"), init=False)

    def request(self, path: str, params: dict | None = None, external: bool = False) -> tuple[int, dict, bytes]:
        url = path if path.startswith("http") else self.base.rstrip("/") + path
        headers = {} if external else {"Authorization": f"apikey token={self.key}", "Accept": "application/json"}
        wait = 1.0
        for attempt in range(self.retries + 1):
            pause = self._last + 1.0 / self.per_second - self.clock()
            if pause > 0:
                self.sleep(pause)
            self._last = self.clock()
            try:
                status, told, body = self.send(url, params or {}, headers)
            except OSError:
                if attempt == self.retries:
                    raise
                told = {}
            else:
                if status == 401 and not external:
                    raise AuthError(url)
                if status != 429 and status < 500 or attempt == self.retries:
                    return status, told, body
            told_wait = told.get("Retry-After", "")
            self.sleep(float(told_wait) if told_wait.replace(".", "", 1).isdigit() else wait)
            wait *= 2
        raise AssertionError("unreachable")

    def json(self, path: str, params: dict | None = None):
        status, _, body = self.request(path, params)
        return status, json.loads(body) if status == 200 else None


def catalog(spark: SparkSession, client: Client, todo: Iterable[str], now: str) -> DataFrame:
    """Catalog rows (see quillon.schemas) of the acronyms."""
    rows = []
    status, listed = client.json("/ontologies")
    names = {o["acronym"]: o for o in listed or []}
    for acronym in todo:
        began = client.clock()
        row = {"acronym": acronym, "name": (names.get(acronym) or {}).get("name"), "ontology_json": json.dumps(names.get(acronym) or {}), "fetched_at": now, "submission_id": -1}
        try:
            status, submission = client.json(f"/ontologies/{acronym}/latest_submission")
            if status == 200 and submission and submission.get("submissionId") is not None:
                _, metrics = client.json(f"/ontologies/{acronym}/metrics")
                row |= {"status": "ok", "submission_id": int(submission["submissionId"]), "submission_json": json.dumps(submission), "metrics_json": json.dumps(metrics)}
            elif status in (200, 404):
                row |= {"status": "no_submission"}
            else:
                row |= {"status": "error", "error": f"HTTP {status}"}
        except OSError as error:
            row |= {"status": "error", "error": str(error)[:300]}
        rows.append(row | {"api_seconds": client.clock() - began})
    return spark.createDataFrame(rows, schemas.CATALOG)


#: Where a file can come from, in the order to try.
VARIANTS = (
    ("rdf:submission", "/ontologies/{acronym}/submissions/{submission_id}/download", {"download_format": "rdf"}),
    ("rdf:latest", "/ontologies/{acronym}/download", {"download_format": "rdf"}),
    ("original:submission", "/ontologies/{acronym}/submissions/{submission_id}/download", {}),
)


def outcome(status: int, headers: dict, body: bytes, most: int | None) -> str:
    """ok, not_downloadable, not_found, skipped_too_large, html_response or failed."""
    if status in (401, 403):
        return "not_downloadable"
    if status == 404:
        return "not_found"
    if status != 200:
        return "failed"
    if most and (int(headers.get("Content-Length") or 0) > most or len(body) > most):
        return "skipped_too_large"
    head = body[:512].lstrip().lower()
    return "html_response" if head.startswith((b"<!doctype html", b"<html")) and b"<rdf:rdf" not in body[:65536].lower() else "ok"


def fetch(client: Client, acronym: str, submission_id: int, most: int | None = None, variants=VARIANTS) -> tuple[dict, bytes | None]:
    """The download row of an ontology and its bytes; every attempt is logged. Stops at ok, a refusal or a file that is too large."""
    log, row = [], {"acronym": acronym, "submission_id": submission_id}
    for name, path, params in variants:
        external = path.startswith("http")
        status = 0
        try:
            address = path if external else path.format(acronym=acronym, submission_id=submission_id)
            status, headers, body = client.request(address, params, external)
            what = outcome(status, headers, body, most)
        except AuthError:
            what, headers, body = "not_downloadable", {}, b""
        except OSError as error:
            what, headers, body = "failed", {}, str(error).encode()
        log.append({"variant": name, "outcome": what, "http_status": status, "bytes": len(body)})
        row |= {"status": what, "variant": name, "http_status": status, "attempts": len(log), "attempts_log": json.dumps(log)}
        if what == "ok":
            row |= {"bytes": len(body), "sha256": hashlib.sha256(body).hexdigest(), "content_type": headers.get("Content-Type"), "disposition": headers.get("Content-Disposition")}
            return row, body
        if what in ("not_downloadable", "skipped_too_large"):
            break
    return row, None


_LANDED = pa.schema(
    [
        ("acronym", pa.string()), ("submission_id", pa.int64()), ("status", pa.string()), ("variant", pa.string()), ("http_status", pa.int32()), ("attempts", pa.int32()),
        ("attempts_log", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("content_type", pa.string()), ("disposition", pa.string()), ("seconds", pa.float64()),
        ("content", pa.binary()),
    ]
)
_LANDED_DDL = (
    "acronym string, submission_id bigint, status string, variant string, http_status int, attempts int, attempts_log string, bytes bigint, sha256 string, "
    "content_type string, disposition string, seconds double, content binary"
)


def landed(todo: DataFrame, connect: Callable[[], Client], tasks: int = 1, most: int | None = MOST_BYTES, variants=VARIANTS) -> DataFrame:
    """Download rows with their content of ``todo`` (acronym, submission_id, url, size), the smallest first in each task.

    Without a url the registry's variants are tried, else that address alone. ``connect`` makes the client of a task; each of
    the ``tasks`` gets its part of the client's rate and holds one file at a time. Computing the result asks the network, so
    write it before it is used twice.
    """

    def run(batches):
        client = connect()
        client.per_second /= tasks
        for batch in batches:
            for acronym, submission_id, url in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                began = client.clock()
                ways = variants if url is None else ((f"url:{urlsplit(url).netloc or 'url'}", url, {}),)
                row, body = fetch(client, acronym, submission_id, most, ways)
                row |= {"seconds": client.clock() - began, "content": body}
                yield pa.RecordBatch.from_pylist([{n: row.get(n) for n in _LANDED.names}], schema=_LANDED)

    dealt = todo.select("acronym", F.col("submission_id").cast("long"), F.col("url").cast("string"), "size").repartition(tasks)
    return dealt.sortWithinPartitions(F.col("size").asc_nulls_last(), "acronym").drop("size").mapInArrow(run, _LANDED_DDL)


def restricted(catalog_rows: DataFrame) -> DataFrame:
    """(acronym, status) of ontologies that are not asked for: private and summary-only ones."""
    view = F.get_json_object("ontology_json", "$.viewingRestriction")
    brief = F.get_json_object("ontology_json", "$.summaryOnly") == "true"
    state = F.when(view == "private", "private").when(brief, "summary_only")
    return catalog_rows.select("acronym", state.alias("status")).where("status IS NOT NULL")


def local_file(spark: SparkSession, acronym: str, path: str, submission_id: int = 0) -> DataFrame:
    """A local file as a download row; from there on it goes the way of all others."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.lit(acronym).alias("acronym"), F.lit(submission_id).cast("long").alias("submission_id"), F.lit("ok").alias("status"), F.lit("local").alias("variant"),
        F.col("path").alias("raw_path"), F.col("path").alias("eval_path"), F.col("length").alias("bytes"), F.col("length").alias("eval_bytes"), F.sha2("content", 256).alias("sha256"),
    )


def search_hits(documents: DataFrame) -> DataFrame:
    """Hits (see quillon.schemas) of landed answers (keyword, body): rank is the place in the list; items without an ontology keep it."""
    item = "struct<prefLabel: string, synonym: string, links: struct<ontology: string>>"
    listed = F.from_json("body", f"struct<collection: array<{item}>, totalCount: bigint>")

    def strings(x):
        return F.when(x.startswith("["), F.from_json(x, "array<string>")).when(x.isNotNull(), F.array(x)).otherwise(F.array().cast("array<string>"))

    rows = documents.select("keyword", F.posexplode(listed["collection"]).alias("rank", "hit"))
    link = F.regexp_replace("hit.links.ontology", "/$", "")
    return rows.select("keyword", "rank", F.substring_index(link, "/", -1).alias("acronym"), strings(F.col("hit.prefLabel")).alias("pref_label"), strings(F.col("hit.synonym")).alias("synonym"))
