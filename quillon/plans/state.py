"""State of a scoring campaign: upserts, the work queue, plans and the nightly comparison.

Tables are Parquet; an upsert is a join whose result replaces the table (write to a new path, then swap).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon import vocab as V

# Fixed sets of states.
RETRYABLE = ("error", "crashed", "interrupted", "memory_error")
TERMINAL = ("done", "parse_failed", "timeout", "memory_limit", "gave_up", "skipped")
REQUEUED = ("timeout", "memory_limit", "gave_up", "error", "crashed")
KEEP_OLD = ("too_large", "timed_out", "failed")
KEY = ["acronym", "submission_id"]
MAX_ATTEMPTS = 2
NIGHTLY_CAP = 60


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace the columns they supply (nulls too); other columns and rows stay."""
    supplied = [c for c in new.columns if c not in key]
    marked = new.select(*key, *[F.col(c).alias(f"_new_{c}") for c in supplied], F.lit(True).alias("_in"))
    joined = old.join(marked, list(key), "full")
    return joined.select(*[F.when(F.col("_in"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in supplied else F.col(c) for c in old.columns])


def replace(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` replace whole rows; columns that they lack become null."""
    return old.join(new.select(*key), list(key), "left_anti").unionByName(new, allowMissingColumns=True).select(*old.columns)


def interrupted(evaluations: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Runs that an ended session left open become interrupted, or gave_up after the last attempt."""
    was = F.col("status") == "running"
    status = F.when(was, F.when(F.col("attempts") >= max_attempts, "gave_up").otherwise("interrupted")).otherwise(F.col("status"))
    error = F.when(was, F.concat(F.coalesce("error", F.lit("")), F.lit(" [session ended while running]"))).otherwise(F.col("error"))
    return evaluations.withColumns({"status": status, "error": error})


def wanted(df: DataFrame, acronyms: Sequence[str] | None) -> DataFrame:
    return df if not acronyms else df.where(F.upper("acronym").isin(*[a.upper() for a in acronyms]))


def work_queue(downloads: DataFrame, evaluations: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(acronym, submission_id, eval_bytes, eval_status, eval_attempts, action): action is run or gave_up; final ones are left out."""
    runs = evaluations.select(*KEY, F.col("status").alias("eval_status"), F.col("attempts").alias("eval_attempts"))
    rows = downloads.where("status = 'ok'").select(*KEY, "eval_bytes").join(runs, KEY, "left").where(~F.coalesce(F.col("eval_status").isin(*TERMINAL), F.lit(False)))
    tired = F.col("eval_status").isin(*RETRYABLE) & (F.coalesce("eval_attempts", F.lit(0)) >= max_attempts)
    return rows.withColumn("action", F.when(tired, "gave_up").otherwise("run"))


def in_order(queue: DataFrame, unknown_last: bool = False) -> DataFrame:
    """Smallest files first; unknown sizes before them, as the campaign takes them, or after them, as downloads are taken."""
    size = F.col("eval_bytes")
    return queue.orderBy(size.asc_nulls_last() if unknown_last else size.asc_nulls_first(), "acronym", "submission_id")


def size_totals(queue: DataFrame) -> DataFrame:
    """(action, files, unknown, bytes): what a queue holds; unknown sizes count 0."""
    return queue.groupBy("action").agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("eval_bytes").isNull()).alias("unknown"), F.sum(F.coalesce("eval_bytes", F.lit(0))).alias("bytes"))


def started(evaluations: DataFrame, keys: DataFrame, run_id: str, at: Column) -> DataFrame:
    """The rows of ``keys`` become running, with one more attempt."""
    tries = keys.select(*KEY).join(evaluations.select(*KEY, "attempts"), KEY, "left")
    null = lambda c: F.lit(None).cast("string").alias(c)
    new = tries.select(
        *KEY, F.lit("running").alias("status"), (F.coalesce("attempts", F.lit(0)) + 1).cast("int").alias("attempts"), at.cast("string").alias("started_at"),
        F.lit(run_id).alias("run_id"), null("error"), null("error_type"), null("traceback"), null("stage_at_failure"),
    )
    return upsert(evaluations, new, KEY)


def finished(evaluations: DataFrame, results: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Results (key, status, scores, ...) go into the rows; a failed run leaves no scores of an earlier one."""
    scores = ["describe_score", "define_score", "connection_score", "flat_score", "core_average", "summary_json", "result_path", "entities_path"]
    tries = results.join(evaluations.select(*KEY, F.col("attempts").alias("_tries")), KEY, "left")
    done = F.col("status") == "done"
    tired = F.col("status").isin(*RETRYABLE) & (F.coalesce("_tries", F.lit(0)) >= max_attempts)
    kinds = dict(evaluations.dtypes)
    have = {c: F.when(done, F.col(c)) if c in results.columns else F.lit(None).cast(kinds[c]) for c in scores}
    new = tries.withColumns(have).withColumn("status", F.when(tired, "gave_up").otherwise(F.col("status"))).drop("_tries")
    return upsert(evaluations, new, KEY)


def requeued(evaluations: DataFrame, statuses: Sequence[str] = REQUEUED, acronyms: Sequence[str] | None = None) -> DataFrame:
    """Runs in these states go back to pending, with no attempts."""
    hit = F.col("status").isin(*statuses)
    if acronyms:
        hit = hit & F.upper("acronym").isin(*[a.upper() for a in acronyms])
    return evaluations.withColumns({"attempts": F.when(hit, 0).otherwise(F.col("attempts")).cast("int"), "status": F.when(hit, "pending").otherwise(F.col("status"))})


def status_counts(**tables: DataFrame) -> DataFrame:
    """(table, status, n)."""
    out = None
    for name, df in tables.items():
        part = df.groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "status", "n")
        out = part if out is None else out.unionByName(part)
    return out


def latest(df: DataFrame) -> DataFrame:
    """The row of the last submission of each acronym."""
    order = Window.partitionBy("acronym").orderBy(F.col("submission_id").desc_nulls_last())
    return df.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def definition_iris(submission_json: Column) -> Column:
    """The definition properties that a submission declares: a text, an object with @id, or a list of either."""
    value = F.get_json_object(submission_json, "$.definitionProperty")
    listed = F.from_json(value, "array<string>")
    items = F.when(value.startswith("["), listed).when(value.isNotNull(), F.array(value))
    plain = F.transform(items, lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$['@id']")).otherwise(x))
    return F.coalesce(F.filter(plain, lambda x: x.startswith("http")), F.array().cast("array<string>"))


def upgrade_plan(catalog: DataFrame, downloads: DataFrame, evaluations: DataFrame) -> DataFrame:
    """(acronym, download_failed, parse_failed, empty, define_candidate, reasons, flat_recheck, already_done): what an update has to touch.

    Rows join by acronym alone, each table's last submission.
    """
    d = latest(downloads).select("acronym", F.col("status").alias("d_status"))
    e = latest(evaluations).select("acronym", F.col("status").alias("e_status"), "summary_json")
    c = catalog.select("acronym", "submission_json", "metrics_json")
    rows = d.join(e, "acronym", "full").join(c, "acronym", "left")

    def number(source: str, name: str) -> Column:
        return F.expr(f"try_cast(get_json_object({source}, '$.{name}') AS BIGINT)")

    entities = number("summary_json", "entities")
    has_bp = F.get_json_object("summary_json", "$.define_bp_score").isNotNull()
    done = F.coalesce(F.col("e_status") == "done", F.lit(False))
    empty = done & F.coalesce(entities == 0, F.lit(False))
    open_rows = done & ~empty & ~has_bp
    extra = F.filter(definition_iris(F.col("submission_json")), lambda x: ~x.isin(*V.DEFINITION_PROPERTIES))
    counted = F.coalesce(number("metrics_json", "classes"), F.lit(0)) - F.coalesce(number("metrics_json", "classesWithNoDefinition"), F.lit(0))
    found = F.coalesce(number("summary_json", "define_defined"), F.lit(0))
    reasons = F.array_compact(
        F.array(
            F.when(F.size(extra) > 0, F.concat(F.lit("BioPortal definition property "), F.array_join(extra, ", "))),
            F.when((counted >= 10) & (found < 0.5 * counted), F.concat(F.lit("BioPortal counts "), counted.cast("string"), F.lit(" definitions, found "), found.cast("string"))),
        )
    )
    recheck = (F.coalesce(number("summary_json", "flat_cycle_back_edges"), F.lit(0)) > 0) & (F.coalesce(number("summary_json", "flat_max_depth"), F.lit(0)) <= 6)
    flag = lambda x: F.coalesce(x, F.lit(False))
    return rows.select(
        "acronym",
        flag(F.col("d_status").isin("failed", "html_response", "not_found")).alias("download_failed"),
        flag(F.col("e_status") == "parse_failed").alias("parse_failed"), empty.alias("empty"),
        (open_rows & (F.size(reasons) > 0)).alias("define_candidate"),
        F.when(open_rows, F.nullif(F.array_join(reasons, "; "), F.lit(""))).alias("reasons"),
        (open_rows & recheck).alias("flat_recheck"), (done & ~empty & has_bp).alias("already_done"),
    )


def repair_targets(plan: DataFrame) -> DataFrame:
    return plan.where("download_failed OR parse_failed OR empty").select("acronym").distinct()


def older_results(evaluations: DataFrame, version: str) -> DataFrame:
    """Acronyms whose extended Define used extra properties under another version."""
    get = lambda name: F.get_json_object("summary_json", f"$.{name}")
    source = F.coalesce(get("define_bp_source"), F.lit(""))
    old = (F.col("status") == "done") & get("define_bp_score").isNotNull() & (source != "") & ~source.startswith("same_as_strict")
    return evaluations.where(old & ~get("core4_version").eqNullSafe(F.lit(version))).select("acronym").distinct()


def rescoring(plan: DataFrame, evaluations: DataFrame, version: str, full: bool = False) -> DataFrame:
    """Acronyms to score again for the extended Define."""
    if full:
        return evaluations.where("status = 'done'").select("acronym").distinct()
    chosen = plan.where("define_candidate OR flat_recheck").select("acronym")
    return chosen.unionByName(older_results(evaluations, version)).distinct()


def alternate_sources(rows: DataFrame) -> DataFrame:
    """(acronym, at, variant, url, external): other places of a file, in the order to try them.

    ``rows``: acronym, submission_id, variant, sniffed_format, submission_json.
    """
    language = F.upper(F.coalesce(F.get_json_object("submission_json", "$.hasOntologyLanguage"), F.lit("")))
    pull = F.get_json_object("submission_json", "$.pullLocation")
    original = F.when(
        ~F.coalesce("variant", F.lit("")).startswith("original"),
        F.struct(F.lit("original:submission").alias("variant"), F.format_string("/ontologies/%s/submissions/%d/download", "acronym", F.col("submission_id").cast("long")).alias("url"), F.lit(False).alias("external")),
    )
    low = F.lower(pull)
    direct = F.when(pull.startswith("http"), F.when(low.endswith(".obo"), F.concat(F.expr("left(get_json_object(submission_json, '$.pullLocation'), length(get_json_object(submission_json, '$.pullLocation')) - 4)"), F.lit(".owl"))).when(low.rlike(r"\.(owl|rdf|ttl|owl\.gz)$"), pull))
    is_obo = (language == "OBO") | F.coalesce(F.col("sniffed_format") == "obo", F.lit(False))
    urls = F.when(is_obo, F.array_distinct(F.array_compact(F.array(direct, F.concat(F.lit("http://purl.obolibrary.org/obo/"), F.lower("acronym"), F.lit(".owl"))))))
    obo = F.transform(F.coalesce(urls, F.array().cast("array<string>")), lambda u, i: F.struct(F.concat(F.lit("obo_owl:"), i.cast("string")).alias("variant"), u.alias("url"), F.lit(True).alias("external")))
    every = F.concat(F.array_compact(F.array(original)), obo)
    return rows.select("acronym", F.posexplode(every).alias("at", "s")).select("acronym", "at", "s.*")


def is_good() -> Column:
    """A finished run with entities."""
    return (F.col("status") == "done") & (F.coalesce(F.expr("try_cast(get_json_object(summary_json, '$.entities') AS BIGINT)"), F.lit(0)) > 0)


def nightly_diff(catalog: DataFrame, serving: DataFrame, only: Sequence[str] | None = None, cap: int = NIGHTLY_CAP) -> DataFrame:
    """(acronym, reason, deferred): ontologies that are new, have a new submission, or are asked for.

    A submission that is null counts as -1. Beyond ``cap`` rows, by acronym, work is deferred to the next run.
    """
    old = serving.select("acronym", F.col("submission_id").alias("_old"), F.lit(True).alias("_known"))
    rows = catalog.select("acronym", F.coalesce("submission_id", F.lit(-1)).alias("_sub"), "status").join(old, "acronym", "left")
    if only:
        reason = F.when(F.upper("acronym").isin(*[a.upper() for a in only]), "requested")
    else:
        changed = (F.col("status") == "ok") & (F.col("_sub") != F.coalesce("_old", F.lit(-1)))
        shown = F.concat(F.lit("new submission ("), F.coalesce(F.col("_old").cast("string"), F.lit("None")), F.lit(" -> "), F.col("_sub").cast("string"), F.lit(")"))
        reason = F.when(F.col("_known").isNull(), "new ontology").when(changed, shown)
    todo = rows.withColumn("reason", reason).where("reason IS NOT NULL").select("acronym", "reason")
    first = todo.orderBy("acronym").limit(cap).select("acronym", F.lit(False).alias("_now"))
    return todo.join(first, "acronym", "left").select("acronym", "reason", F.col("_now").isNull().alias("deferred"))


def merged_serving(old: DataFrame, new: DataFrame) -> DataFrame:
    """New serving rows over old ones; a scored row whose new status is transient keeps its scores and says so."""
    before = old.select("provider", "acronym", F.col("status").alias("_status"), F.col("submission_id").alias("_sub"))
    rows = new.join(before, ["provider", "acronym"], "left")
    keep = F.col("status").isin(*KEEP_OLD) & F.coalesce(F.col("_status") == "scored", F.lit(False))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    # Fixed text.
    detail = F.concat(
        F.lit("Submission "), number("submission_id"), F.lit(" is not scored yet ("), F.col("status"),
        F.lit(" on the nightly runner); the scores shown are for submission "), number("_sub"), F.lit(". Run it on the GPU machine."),
    )
    kept = rows.where(keep).select("provider", "acronym", detail.alias("status_detail"), "updated_at")
    replaced = rows.where(~keep).select(*new.columns)
    return upsert(replace(old, replaced, ["provider", "acronym"]), kept, ["provider", "acronym"])


def pilot(rows: DataFrame, n: int = 20, seed: int = 7) -> DataFrame:
    """About n acronyms spread over four bins of class counts, by sha256 of seed and acronym; short bins are topped up.

    ``rows``: acronym, bp_classes.
    """
    bin_of = F.when(F.col("bp_classes") < 1_000, 0).when(F.col("bp_classes") < 20_000, 1).when(F.col("bp_classes") < 200_000, 2).otherwise(3)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("acronym")), 256)
    per_bin = max(1, n // 4)
    keyed = rows.where("bp_classes IS NOT NULL").select("acronym", bin_of.alias("bin"), order.alias("k"))
    first = None
    for b in range(4):  # a bin's head is a bounded top-k, with no window over the bin
        part = keyed.where(F.col("bin") == b).orderBy("k", "acronym").limit(per_bin)
        first = part if first is None else first.unionByName(part)
    first = first.withColumn("stage", F.lit(0))
    rest = keyed.join(first.select("acronym"), "acronym", "left_anti").withColumn("stage", F.lit(1)).orderBy("k", "acronym").limit(n)
    return first.unionByName(rest).orderBy("stage", "k", "acronym").limit(max(n, first.count())).select("acronym", "bin")


def eligible(catalog: DataFrame) -> DataFrame:
    """Catalog rows that a pilot may take."""
    return catalog.where(
        "catalog_status = 'ok' AND NOT coalesce(bp_viewing_restriction = 'private', false) AND NOT coalesce(bp_summary_only, false) AND bp_classes IS NOT NULL"
    )


def incremental_todo(listing: DataFrame, known: DataFrame, only: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """Listed acronyms, in order, without those that are already ok or have no submission."""
    rows = wanted(listing, only).orderBy("acronym")
    rows = rows.limit(limit) if limit else rows
    return rows.join(known.where("status IN ('ok', 'no_submission')").select("acronym"), "acronym", "left_anti")
