"""Several sinks fed from the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodewright.session import shared_dir
from lodewright.sinks import commits
from lodewright.sinks.files import TEXT_OPTIONS

Reuse = Literal["scan", "table", "persist"]
RUN, BATCH = "run_id", "batch_id"


@dataclass(frozen=True)
class Sink:
    """Where ``rows(shared)`` goes."""

    path: str
    rows: Callable[[DataFrame], DataFrame]
    file_format: str = "parquet"
    mode: str = "append"


def write_sinks(shared: DataFrame, sinks: Sequence[Sink], reuse: Reuse = "scan") -> None:
    """Write each sink from ``shared``.

    ``scan`` lets each sink read the source with its own filters and columns pushed down: best
    where ``shared`` is little more than a scan. ``table`` first writes the rows once to the shared
    folder: for costly rows, and for rows that would differ when computed again (random values,
    the current time). ``persist`` keeps them on the executors, for inputs of a known size such as
    a micro-batch.
    """
    if reuse == "table":
        path = shared_dir(shared.sparkSession, "shared-rows")
        shared.write.parquet(path)
        shared = shared.sparkSession.read.schema(shared.schema).parquet(path)
    elif reuse == "persist":
        shared = shared.persist()
    try:
        for sink in sinks:
            writer = sink.rows(shared).write.format(sink.file_format).options(**TEXT_OPTIONS)
            writer.mode(sink.mode).save(sink.path)
    finally:
        if reuse == "persist":
            shared.unpersist()


def write_together(
    shared: DataFrame, sinks: Sequence[Sink], log: str, run: str, batch: int = 0, reuse: Reuse = "scan"
) -> None:
    """Write each sink, and let all of them appear at once to those who read with ``read_together``.

    A sink's rows go to a folder of their own below its path. Only when all are written does ``log`` get an entry,
    which is what readers go by: a set that fails in the middle shows nothing, and its repetition, under the same
    ``run`` and ``batch``, replaces what it left and shows once. Batches of a run are numbered as they come.
    """
    own = [replace(s, path=f"{s.path}/{RUN}={run}/{BATCH}={batch}", mode="overwrite") for s in sinks]
    write_sinks(shared, own, reuse)
    commits.put(shared.sparkSession.range(1).select(), log, run, batch)


def read_together(
    spark: SparkSession,
    path: str,
    log: str,
    schema: StructType | str,
    file_format: str = "parquet",
    after: dict[str, int] | None = None,
) -> DataFrame:
    """What finished sets wrote below ``path``, with the columns ``run_id`` and ``batch_id``.

    ``after`` leaves out the batches of a run up to a number; their folders aren't read. Other folders are not read
    either: the log names the last batch of each run, of which there are few.
    """
    entries = commits.newest(spark, log, "ignored string")
    known = {row["name"]: row[commits.NUMBER] for row in entries.collect()} if entries is not None else {}
    wanted = [
        (F.col(RUN) == run) & (F.col(BATCH) > (after or {}).get(run, -1)) & (F.col(BATCH) <= last)
        for run, last in known.items()
        if last > (after or {}).get(run, -1)
    ]
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    full = StructType([*schema.fields]).add(RUN, "string").add(BATCH, "long")
    if not wanted:
        return spark.createDataFrame([], full)
    condition = wanted[0]
    for one in wanted[1:]:
        condition = condition | one
    rows = spark.read.schema(full).options(**TEXT_OPTIONS).option("ignoreMissingFiles", True)
    return rows.format(file_format).load(path).where(condition)
