"""A campaign's steps put together: files in, evaluation rows, entity tables and reports out."""

from __future__ import annotations

import platform
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.encoder import hashing
from quillon.plans import state
from quillon.plans.scoring import summary
from quillon.session import materialise
from quillon.sources import archives, rdf, registry

KEY = ["acronym", "submission_id"]
SCORES = ["describe_score", "define_score", "connection_score", "flat_score", "core_average"]


def to_download(catalog_rows: DataFrame, downloads: DataFrame, again: bool = False, only: Sequence[str] | None = None) -> DataFrame:
    """(acronym, submission_id, state, attempts, size, master): submissions to ask for, of ``results.catalog_frame``.

    What was asked for before is left out; with ``again`` only what is ok. ``state`` is private or summary_only for those that
    may not be fetched, else null.
    """
    old = downloads.select(*KEY, F.col("status").alias("_was"), F.col("attempts").alias("_tries"))
    settled = F.coalesce(F.col("_was") == "ok", F.lit(False)) if again else F.col("_was").isNotNull()
    closed = F.when(F.col("bp_viewing_restriction") == "private", "private").when(F.col("bp_summary_only"), "summary_only")
    rows = state.wanted(catalog_rows.where("catalog_status = 'ok'"), only).join(old, KEY, "left").where(~settled)
    tries = (F.coalesce("_tries", F.lit(0)) + 1).cast("int").alias("attempts")
    return rows.select(*KEY, closed.alias("state"), tries, F.col("bp_classes").alias("size"), F.col("bp_master_file_name").alias("master"))


def download(
    catalog_rows: DataFrame, downloads: DataFrame, connect: Callable[[], registry.Client], now: Column, run_id: str, again: bool = False, only: Sequence[str] | None = None,
    limit: int | None = None, tasks: int = 1, most: int | None = archives.MOST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The downloads table after a run, and the fetched files (acronym, submission_id, content, master) as a written table.

    Ontologies with the fewest classes come first, unknown numbers last. Files are fetched in tasks (see ``registry.landed``).
    """
    todo = to_download(catalog_rows, downloads, again, only)
    todo = materialise(todo.orderBy(F.col("size").asc_nulls_last(), "acronym").limit(limit) if limit else todo)
    got = materialise(registry.landed(todo.where("state IS NULL").withColumn("url", F.lit(None)), connect, tasks, most))
    rows = todo.select(*KEY, "state", "attempts").join(_told(got, todo.select(*KEY, "master")).drop("attempts"), KEY, "left")
    new = rows.withColumn("status", F.coalesce("state", "status")).drop("state").withColumns({"started_at": now.cast("string"), "finished_at": now.cast("string"), "run_id": F.lit(run_id)})
    files = got.where("status = 'ok'").select(*KEY, "content").join(todo.select(*KEY, "master"), KEY)
    return state.upsert(downloads, new, KEY), files


def download_from(
    places: DataFrame, downloads: DataFrame, evaluations: DataFrame, connect: Callable[[], registry.Client], now: Column, run_id: str, force: bool = False, tasks: int = 1,
    most: int | None = archives.MOST_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files of other addresses, ``places`` (acronym, url): the downloads table, the files, and (acronym, outcome) of all places.

    An acronym that was never asked for is unknown_acronym; one with a good result is already_scored unless ``force``. Only an
    ok outcome changes its download row, whose log it joins.
    """
    known = state.latest(downloads).select(*KEY, F.col("attempts_log").alias("_log"))
    good = evaluations.where(state.is_good()).select("acronym").distinct().withColumn("_good", F.lit(True))
    asked = places.dropDuplicates(["acronym"]).join(known, "acronym", "left").join(good, "acronym", "left")
    why = F.when(F.col("submission_id").isNull(), "unknown_acronym").when(F.coalesce("_good", F.lit(False)) & ~F.lit(force), "already_scored")
    asked = materialise(asked.select(*KEY, "url", "_log", why.alias("outcome")))
    todo = asked.where("outcome IS NULL")
    got = materialise(registry.landed(todo.withColumn("size", F.lit(None).cast("long")), connect, tasks, most))
    good_ones = got.where("status = 'ok'")
    logs = F.when(F.coalesce(F.length("_log"), F.lit(0)) > 2, F.concat(F.expr("left(_log, length(_log) - 1)"), F.lit(", "), F.expr("substring(attempts_log, 2)"))).otherwise(F.col("attempts_log"))
    told = _told(good_ones, good_ones.select(*KEY, F.lit(None).cast("string").alias("master"))).drop("attempts").join(todo.select(*KEY, "_log", "url"), KEY)
    new = told.withColumns({"attempts_log": logs, "finished_at": now.cast("string"), "run_id": F.lit(run_id)}).drop("_log")
    outcomes = asked.join(got.select("acronym", "status"), "acronym", "left").select("acronym", F.coalesce("outcome", "status").alias("outcome"))
    return state.upsert(downloads, new, KEY), good_ones.select(*KEY, "content", F.lit(None).cast("string").alias("master")), outcomes


def _told(got: DataFrame, masters: DataFrame) -> DataFrame:
    """Columns of download rows of landed files: what an ok file holds once opened, and why another isn't ok."""
    name = F.to_json(F.struct(*KEY)).alias("onto_id")
    opened = archives.expanded(got.where("status = 'ok'").select(*KEY, "content", name).join(masters, KEY)).select(
        "onto_id", F.octet_length("content").cast("long").alias("eval_bytes"), "sniffed_format", "archive_type", F.to_json("archive_members").alias("archive_members")
    )
    ok = F.col("status") == "ok"
    rows = got.select(
        *[c for c in got.columns if c not in ("content", "disposition")], name, archives.server_filename(F.when(ok, F.col("disposition"))).alias("server_filename"),
        F.when(~ok, F.concat(F.col("status"), F.lit(" (HTTP "), F.col("http_status").cast("string"), F.lit(")"))).alias("error"),
    )
    return rows.join(opened, "onto_id", "left").drop("onto_id")


def evaluate(files: DataFrame, now: Column, run_id: str, declared: DataFrame | None = None, encoder: Callable[[Column], Column] = hashing) -> DataFrame:
    """Columns of evaluation rows, to be upserted, of files (acronym, submission_id, content, master).

    Archives are opened, formats sniffed, parsers tried in turn; what can't be read becomes a row with status parse_failed and
    its error, and all others are scored by one plan. ``declared`` (onto_id, iri, at) are the registry's definition properties
    of an acronym. Submissions of one acronym are ontologies of their own.
    """
    name = F.to_json(F.struct(*KEY)).alias("onto_id")
    opened = archives.expanded(files.withColumn("onto_id", name))
    keys = files.select(*KEY, name).distinct()
    if declared is not None:
        declared = keys.join(declared.withColumnRenamed("onto_id", "acronym"), "acronym").select("onto_id", "iri", "at")
    parsed = materialise(rdf.parsed(opened))
    scored = summary(rdf.triples(parsed), declared, encoder)
    scored = scored.select("onto_id", *[F.col(c).cast("double").alias(c) for c in SCORES], F.to_json(F.struct(*[c for c in scored.columns if c not in ("onto_id", *SCORES)])).alias("summary_json"))
    rows = keys.join(parsed.select("onto_id", "error", "format"), "onto_id", "left").join(scored, "onto_id", "left")
    failed = F.col("error").isNotNull()
    have = {
        "acronym": F.col("acronym"), "submission_id": F.col("submission_id").cast("long"), "status": F.when(failed, "parse_failed").otherwise("done"), "finished_at": now.cast("string"),
        "error": F.col("error"), "error_type": F.when(failed, "ParseError"), "stage_at_failure": F.when(failed, "parse"), "run_id": F.lit(run_id),
        # A file without triples was read, and is an ontology without entities.
        "summary_json": F.when(~failed, F.coalesce("summary_json", F.lit('{"entities":0}'))),
        **{c: F.when(~failed, F.coalesce(c, F.lit(0.0))) for c in SCORES},
    }
    return rows.select(*[column.alias(name) for name, column in have.items()])


def run_queue(downloads: DataFrame, evaluations: DataFrame, files: DataFrame, now: Column, run_id: str, limit: int | None = None, **more) -> DataFrame:
    """The evaluations table after one pass over the work queue, smallest files first."""
    queue = state.work_queue(downloads, state.interrupted(evaluations))
    todo = state.in_order(queue.where("action = 'run'")).select(*KEY)
    todo = materialise(todo.limit(limit) if limit else todo)
    tired = queue.where("action = 'gave_up'").select(*KEY, F.lit("gave_up").alias("status"))
    begun = state.started(state.upsert(state.interrupted(evaluations), tired, KEY), todo, run_id, now)
    return state.finished(begun, evaluate(files.join(todo, KEY, "left_semi"), now, run_id, **more))


def repair(downloads: DataFrame, evaluations: DataFrame, catalog: DataFrame, files: DataFrame, now: Column, run_id: str, fetch: Callable[[DataFrame], DataFrame] | None = None, **more) -> DataFrame:
    """The evaluations table after a repair: failures and empty results are read again, then other places are tried.

    ``fetch`` takes the alternate sources (acronym, at, variant, url, external) and gives files (acronym, submission_id,
    content, master) of the first place that answered. What was no ontology is not asked for again.
    """
    targets = materialise(state.repair_targets(state.upgrade_plan(catalog, downloads, evaluations)))
    again = evaluate(files.join(targets, "acronym", "left_semi"), now, run_id, **more)
    first = materialise(state.upsert(evaluations, again, KEY))
    if fetch is None:
        return first
    bad = first.join(targets, "acronym", "left_semi").where(~state.is_good() & ~F.coalesce("error", F.lit("")).startswith("not_an_ontology"))
    places = state.alternate_sources(
        downloads.where("status = 'ok'").join(bad.select("acronym").distinct(), "acronym", "left_semi").join(catalog.select("acronym", "submission_json"), "acronym", "left")
    )
    second = evaluate(fetch(places), now, run_id, **more).where(state.is_good())
    return state.upsert(first, second, KEY)


def write_entities(table: DataFrame, path: str, most: int | None = None) -> None:
    """The entity table as gzip CSV by ontology; ``most`` keeps that many rows an ontology, by IRI."""
    if most is not None:
        from pyspark.sql import Window

        order = Window.partitionBy("onto_id").orderBy("iri")
        table = table.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).drop("_r")
    table.write.mode("overwrite").partitionBy("onto_id").option("header", "true").option("compression", "gzip").csv(path)


def parity(scores: DataFrame, expected: DataFrame) -> DataFrame:
    """(onto_id, metric, got, want) where a score of a golden ontology is not exactly the expected one; empty if all are."""
    def tall(df: DataFrame, name: str) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias(name)) for c in SCORES[:4]]))
        return df.select("onto_id", pairs.alias("p")).select("onto_id", "p.*")

    return tall(expected, "want").join(tall(scores, "got"), ["onto_id", "metric"], "left").where("NOT got <=> want").select("onto_id", "metric", "got", "want")


def session_report(spark: SparkSession) -> dict:
    """What a run stood on."""
    conf = {k: v for k, v in spark.sparkContext.getConf().getAll() if not any(w in k.lower() for w in ("password", "secret", "token", "key"))}
    return {"spark": spark.version, "python": platform.python_version(), "system": platform.platform(), "parallelism": spark.sparkContext.defaultParallelism, "conf": conf}
