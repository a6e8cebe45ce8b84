"""What the operators share: input columns under fixed names, written steps, files of the shared folder."""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from lodewright.session import shared_dir

# Bytes of texts that a task works on at once.
SLICE_BYTES = 4 << 20
# Fixed value: white space that parts words, the same for every operator.
WORD = r"[^\x20\x09-\x0D]+"
# Whether Spark deletes a query's shuffle files when the query ends, not when the driver's garbage is collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(frame: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The two columns that text operators use, named ``doc_id`` and ``text``; a null text is empty."""
    return frame.select(
        frame[key].alias("doc_id"), F.coalesce(frame[text], F.lit("")).alias("text")
    )


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: later steps read it, also after executors are lost."""
    spark = frame.sparkSession
    path = shared_dir(spark, label)
    write(frame.write, spark, path)
    stored = spark.read.schema(frame.schema).parquet(path)
    stored.written_at = path
    return stored


def write(writer: DataFrameWriter, spark: SparkSession, path: str) -> None:
    """Writes Parquet files. What the query shuffled is deleted at its end; later steps read the files."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        writer.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it; for files that Spark has no reader for."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


def discard(*frames: DataFrame) -> None:
    """Deletes what ``written`` wrote, once nothing that is still to run reads it."""
    for frame in frames:
        source, path = open_folder(frame.written_at)
        source.delete_dir(path)


def slices(batches, column: int, size: int = SLICE_BYTES):
    """The batches in parts whose texts, in that column, have about so many bytes; a longer text is alone."""
    for batch in batches:
        ends = pc.cumulative_sum(pc.binary_length(batch.column(column))).to_numpy()
        first = 0
        while first < batch.num_rows:
            done = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(first, last - first)
            first = last


def lower_ascii(text):
    """A-Z in lower case; other letters stay."""
    return F.translate(
        text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
