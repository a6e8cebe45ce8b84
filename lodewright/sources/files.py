"""Scripts, text lines, CSV and the given Parquet tables, as batches or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodewright.sinks.files import TEXT_OPTIONS

# What one batch of a stream takes at most, so that a backlog is worked off in steps.
BATCH_BOUNDS = {"maxBytesPerTrigger": 64 << 30}


def read_scripts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(script_id, text)``, one row per file below ``path`` (any Hadoop URI or glob).

    Whole files, because the order of lines is lost once a file is split.
    """
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("script_id"), F.col("value").alias("text")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``, one row per line. Lines of one file may come from several tasks."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of files as they appear in the folder ``path``."""
    return spark.readStream.options(**BATCH_BOUNDS).text(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header, checked against ``schema``.

    A schema is required: inference would turn codes such as ``'00'`` into numbers.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, mode="FAILFAST", **TEXT_OPTIONS)
        .csv(path)
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream of its files.

    The one-letter class makes the path a pattern: a stream takes a folder or a pattern,
    and the table may be a single file.
    """
    schema = table(spark, folder, name).schema
    reader = spark.readStream.schema(schema).options(**BATCH_BOUNDS)
    return reader.parquet(f"{folder}/{name}.parque[t]")
