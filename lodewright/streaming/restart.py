"""What a stream's checkpoint folder holds, as frames, and what a changed job leaves out of it.

A checkpoint has a log of the batches that were planned (``offsets``), one of those that were finished (``commits``)
and the state of operators that keep some. A job may be started again on it with other sinks; its sources and its
operators with state must be the same in number and kind. ``left_out`` says what of the old job goes on no more.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "value string, batch_id long, line long"
_STATES = "operator_id long, operator string, store string, partitions int, first_batch long, last_batch long"


def _log(spark: SparkSession, checkpoint: str, folder: str) -> DataFrame:
    """The lines of a log's entries, each entry a small file named by its batch."""
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    try:
        files = spark.read.text(f"{checkpoint.rstrip('/')}/{folder}", wholetext=True, pathGlobFilter="[0-9]*")
        files = files.select("value", name.alias("name"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG)
    plain = files.where(F.col("name").rlike("^[0-9]+$"))
    lines = plain.select(F.col("name").cast("long").alias("batch_id"), F.posexplode(F.split("value", "\n")))
    return lines.select(F.col("col").alias("value"), "batch_id", F.col("pos").cast("long").alias("line"))


def batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch_id, source, offset, finished): how far each source of a batch went.

    Sources count from 0, as the job names them. A source without news in a batch has no offset. The entry's first
    line is its version and its second the settings; a batch without a commit runs again after a restart.
    """
    offsets = _log(spark, checkpoint, "offsets").where("line >= 2 and value <> ''")
    finished = _log(spark, checkpoint, "commits").select("batch_id", F.lit(True).alias("finished")).distinct()
    return offsets.join(finished, "batch_id", "left").select(
        "batch_id",
        (F.col("line") - 2).cast("int").alias("source"),
        F.when(F.col("value") != "-", F.col("value")).alias("offset"),
        F.coalesce("finished", F.lit(False)).alias("finished"),
    )


def states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator_id, operator, store, partitions, first_batch, last_batch) of each operator that keeps state."""
    try:
        rows = spark.read.format("state-metadata").load(checkpoint)
        return rows.select(
            F.col("operatorId").alias("operator_id"),
            F.col("operatorName").alias("operator"),
            F.col("stateStoreName").alias("store"),
            F.col("numPartitions").alias("partitions"),
            F.col("minBatchId").alias("first_batch"),
            F.col("maxBatchId").alias("last_batch"),
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STATES)


def sink_batches(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(path, batch_id): the batches that sinks of ``jobs.start_sinks`` have a folder of, from the files' listing."""
    found = None
    number = F.regexp_extract("path", r"/batch_id=([0-9]+)/", 1)
    for path in paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        rows = files.where(number != "").select(F.lit(path).alias("path"), number.cast("long").alias("batch_id"))
        found = rows if found is None else found.unionAll(rows)
    return spark.createDataFrame([], "path string, batch_id long") if found is None else found.distinct()


def left_out(spark: SparkSession, checkpoint: str, before: Iterable[str], now: Iterable[str]) -> DataFrame:
    """(path, change, last_batch, finished_batch): sinks that a changed job drops, adds or keeps.

    ``before`` and ``now`` are the paths of the old and the new sinks. ``last_batch`` is the last one in the sink's
    folder and ``finished_batch`` that of the checkpoint. A ``dropped`` sink stays as it is after ``last_batch``; an
    ``added`` one begins after ``finished_batch`` and holds nothing of the batches up to it; a sink that is ``kept``
    goes on, and a batch beyond ``finished_batch`` is written again.
    """
    before, now = set(before), set(now)
    known = sorted(before | now)
    change = {path: "kept" if path in before & now else "dropped" if path in before else "added" for path in known}
    asked = spark.createDataFrame(sorted(change.items()), "path string, change string")
    last = sink_batches(spark, known).groupBy("path").agg(F.max("batch_id").alias("last_batch"))
    finished = _log(spark, checkpoint, "commits").agg(F.max("batch_id").alias("finished_batch"))
    return asked.join(last, "path", "left").join(F.broadcast(finished), F.lit(True), "left")


class ChangedJobError(ValueError):
    """The checkpoint cannot be gone on with by this job."""


def check_restart(spark: SparkSession, checkpoint: str, sources: int, operators: Iterable[str]) -> None:
    """Raise ``ChangedJobError`` if a job with these ``sources`` and ``operators`` with state can't go on.

    Operators are the names that ``states`` gives, in any order; more sinks or fewer don't matter. A checkpoint
    that has no batch yet fits every job.
    """
    planned = batches(spark, checkpoint).agg(F.max("source") + 1).first()[0]
    if planned is not None and planned != sources:
        raise ChangedJobError(f"{checkpoint}: begun with {planned} sources, the job has {sources}")
    if planned is None:
        return
    had = sorted(row[0] for row in states(spark, checkpoint).select("operator", "operator_id").distinct().collect())
    if had != sorted(operators):
        raise ChangedJobError(f"{checkpoint}: state of {had}, the job has {sorted(operators)}")
