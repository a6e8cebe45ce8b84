"""A small log of what is finished, so that several folders appear together to those who read by it.

An entry is one file of a few rows, written after all that it speaks of; what has no entry isn't there for readers.
A name's entries are numbered, and a later one stands for all before it, so only the last ones are kept: the log
stays as small as it began. A writer that overwrites an old entry never touches the newest.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Entries that are kept of each name.
SLOTS = 16
NUMBER = "commit_number"


def put(rows: DataFrame, log: str, name: str, number: int) -> None:
    """Make ``rows``, a few, the entry ``number`` of ``name``. Numbers of a name rise; a repeated one is replaced."""
    entry = rows.withColumn(NUMBER, F.lit(number).cast("long")).coalesce(1)
    entry.write.mode("overwrite").json(f"{log}/name={name}/slot={number % SLOTS}")


def newest(spark: SparkSession, log: str, schema: str) -> DataFrame | None:
    """The rows of each name's last entry, with ``name`` and the entry's number; None if there is no entry yet."""
    try:
        # A slot may be overwritten while it is listed; its old entry is not wanted any more.
        reader = spark.read.schema(f"{schema}, {NUMBER} long, name string, slot int")
        rows = reader.option("ignoreMissingFiles", True).json(log)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    last = rows.groupBy("name").agg(F.max(NUMBER).alias(NUMBER))
    return rows.drop("slot").join(last, ["name", NUMBER])
