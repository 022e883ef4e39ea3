"""Submissions as a stream: landed files in, an up-to-date serving table out."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillon.plans import state

EVENT = "acronym string, submission_id bigint, status string, landed_at timestamp"


def submissions(spark: SparkSession, folder: str, late: str = "1 day") -> DataFrame:
    """Landed submission records, each (acronym, submission_id) once within the watermark."""
    rows = spark.readStream.schema(EVENT).json(folder)
    return rows.withWatermark("landed_at", late).dropDuplicatesWithinWatermark(["acronym", "submission_id"])


def status_counts(rows: DataFrame, window: str = "1 hour") -> DataFrame:
    """Landed submissions by status and event-time window."""
    return rows.groupBy(F.window("landed_at", window).alias("w"), "status").agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", "status", "n")


_COMMIT = "version bigint, query string, batch bigint"


def _commits(spark: SparkSession, table: str) -> DataFrame:
    """The whole versions of a serving table, none before the first."""
    try:
        return spark.read.schema(_COMMIT).json(f"{table}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)


def keep_serving(rows: DataFrame, table: str, score: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Score every batch of submissions and merge the rows into the serving table at ``table``.

    Versions of the table are folders, and a version counts once a row in ``commits`` names it; nothing that counts is ever
    overwritten. The row also names the stream and the batch, so a batch that is run again after a failure either finds
    itself done or starts from the same version, and a new checkpoint goes on from the last version. One stream writes at a time.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        commits = _commits(spark, table)
        if not commits.where((F.col("query") == query) & (F.col("batch") == number)).isEmpty():
            return
        last = commits.agg(F.max("version")).first()[0]
        new = score(batch)
        merged = new if last is None else state.merged_serving(spark.read.parquet(f"{table}/v{last}"), new)
        version = 0 if last is None else last + 1
        merged.write.mode("overwrite").parquet(f"{table}/v{version}")
        spark.createDataFrame([(version, query, number)], _COMMIT).coalesce(1).write.mode("append").json(f"{table}/commits")

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str) -> DataFrame:
    """The last whole version of a serving table."""
    last = _commits(spark, table).agg(F.max("version")).first()[0]
    if last is None:
        raise ValueError(f"{table} has no whole version")
    return spark.read.parquet(f"{table}/v{last}")
