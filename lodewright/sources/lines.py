"""Text lines with their numbers, from files that are read in several splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodewright.session import shared_dir


def numbered_lines(spark: SparkSession, path: str | list[str], parts: Sequence[str] = ()) -> DataFrame:
    """``(file, line_no, value)`` and the folder columns ``parts`` of every line; numbers begin at 1 in each file.

    A split knows how many lines it has and not how many come before it. The lines are read once and written to the
    shared folder with their split's start and a number that rises within it; the splits' sizes, a row each, are
    added up by file, and each line then adds what comes before its split. No line is sorted or shuffled, and a split
    is read as it was written, whatever the cluster's size is later. Compressed files are one split each.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        # Rows of a split are read in their order, by one task.
        F.monotonically_increasing_id().alias("place"),
        "value",
        *parts,
    )
    kept = shared_dir(spark, "lines")
    lines.write.option("compression", "zstd").parquet(kept)
    stored = spark.read.schema(lines.schema).parquet(kept)
    splits = stored.groupBy("file", "split").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", "split", (F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    return stored.join(offsets, ["file", "split"]).select(
        "file", *parts, (F.col("place") + F.col("offset") + 1).alias("line_no"), "value"
    )
