"""Change rows as a stream: reduced per batch on arrival, folded into tables later.

A batch never rewrites the table. It appends its keys' last changes in a folder of its own number,
so its cost follows the batch and not the table; ``current_rows`` applies all folders when read,
and ``fold`` writes a new version of the table from time to time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodewright.operators.changes import DELETE, apply_changes, latest_changes
from lodewright.sinks.fanout import Sink
from lodewright.sinks.tables import publish
from lodewright.sources.files import BATCH_BOUNDS
from lodewright.streaming.jobs import read_sink, start_sinks
from lodewright.streaming.settings import StreamSettings


def stream_changes(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """Change rows from files. A new checkpoint starts with the earliest file.

    A batch takes at most ``max_files`` files, or else files up to the bound of all streams here.
    """
    bounds = {"maxFilesPerTrigger": max_files} if max_files else BATCH_BOUNDS
    return spark.readStream.schema(schema).options(**bounds).format(file_format).load(path)


def start_changes(
    changes: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str],
    settings: StreamSettings,
    log: str | None = None,
) -> StreamingQuery:
    """Append each batch's last change per key below ``path``; with a ``log``, for ``fold_new`` to go by."""
    sink = Sink(path, lambda batch: latest_changes(batch, keys, order_by))
    return start_sinks(changes, [sink], settings, log)


def current_rows(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    keys: list[str],
    order_by: list[str],
    op: str = "op",
) -> DataFrame:
    """The rows that exist after all changes below ``path``, in the columns of the changes."""
    changes = read_sink(spark, path, schema)
    return latest_changes(changes, keys, order_by).where(F.col(op) != F.lit(DELETE))


def fold(
    spark: SparkSession,
    table: str,
    changes: DataFrame,
    path: str,
    keys: list[str],
    order_by: list[str],
    op: str = "op",
) -> None:
    """Write ``table`` with ``changes`` applied as a new version at ``path``, and switch to it."""
    publish(apply_changes(spark.table(table), changes, keys, order_by, op), table, path)
