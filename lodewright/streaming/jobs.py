"""Streams to files, chained streams, and one stream to several sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodewright.sinks.fanout import BATCH, Sink, write_sinks, write_together
from lodewright.sinks.files import TEXT_OPTIONS
from lodewright.sources.files import BATCH_BOUNDS
from lodewright.streaming.settings import StreamSettings


def start_copy(
    stream: DataFrame,
    path: str,
    settings: StreamSettings,
    file_format: str = "json",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Write a stream to files, each row once: the file log in ``path`` drops repeated batches.

    ``partition_by`` columns become folders, each of which ``sinks.files.compact`` merges once it is
    finished.
    """
    writer = stream.writeStream.format(file_format).options(path=path, **TEXT_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return settings.apply(writer).start()


def follow(
    spark: SparkSession, path: str, schema: StructType | str, file_format: str = "json"
) -> DataFrame:
    """The output of ``start_copy`` as the source of a next stream."""
    reader = spark.readStream.schema(schema).options(**TEXT_OPTIONS, **BATCH_BOUNDS)
    return reader.format(file_format).load(path)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The number that a stream's checkpoint gave it when it was first started."""
    row = spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True)
    return row.select(F.get_json_object("value", "$.id")).first()[0]


def start_sinks(
    stream: DataFrame, sinks: Sequence[Sink], settings: StreamSettings, log: str | None = None
) -> StreamingQuery:
    """Write each micro-batch to every sink.

    A batch may run again after a failure, so it overwrites the folder of its own number. With a ``log`` the sinks
    of a batch appear together (see ``fanout.read_together``), and a stream that begins anew with a new checkpoint,
    and so counts from 0 again, writes to other folders than the one before.
    """

    def write(batch: DataFrame, number: int) -> None:
        reuse = "persist" if len(sinks) > 1 else "scan"
        if log:
            run = query_id(batch.sparkSession, settings.checkpoint)
            write_together(batch, sinks, log, run, number, reuse)
            return
        numbered = [
            replace(sink, path=f"{sink.path}/{BATCH}={number}", mode="overwrite")
            for sink in sinks
        ]
        # With one sink nothing is read twice.
        write_sinks(batch, numbered, reuse)

    return settings.apply(stream.writeStream.foreachBatch(write)).start()


def read_sink(
    spark: SparkSession, path: str, schema: StructType | str, file_format: str = "parquet"
) -> DataFrame:
    """All batches of a sink of ``start_sinks``, without their numbers."""
    reader = spark.read.schema(schema).options(**TEXT_OPTIONS)
    return reader.format(file_format).load(path).drop(BATCH)
