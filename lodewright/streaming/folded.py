"""A table that follows a change stream: each fold reads the new batches only and rewrites the buckets they touch.

Keys are dealt by hash into a fixed number of buckets, a folder each. A version of the table is an entry of a log: the
folder of each bucket, and how far the batches of each run are folded. Folders are never changed; a fold writes
new ones for the buckets that new changes touch and then the entry. The last change of each key is kept, that of
a deleted key too, so a change that comes late, in whichever batch, never undoes a later one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodewright.operators.changes import DELETE, latest_changes
from lodewright.sinks import commits
from lodewright.sinks.fanout import BATCH, RUN, read_together

BUCKET = "key_bucket"
_ENTRY = "kind string, id string, number long, folder string"
_NAME = "table"


def _version(spark: SparkSession, path: str) -> tuple[int, dict[int, str], dict[str, int]]:
    """The newest version: its number (-1 before the first), its buckets' folders, and each run's last folded batch."""
    entry = commits.newest(spark, f"{path}/versions", _ENTRY)
    rows = entry.collect() if entry is not None else []
    buckets = {int(r.number): r.folder for r in rows if r.kind == "bucket"}
    return max((r[commits.NUMBER] for r in rows), default=-1), buckets, {r.id: r.number for r in rows if r.kind == "run"}


def fold_new(
    spark: SparkSession,
    path: str,
    changes: str,
    log: str,
    schema: StructType | str,
    keys: list[str],
    order_by: list[str],
    buckets: int,
) -> list[int]:
    """Fold what ``start_changes`` wrote to ``changes`` with ``log`` since the last call into the table at ``path``.

    Returns the buckets that were rewritten. A bucket is merged by one task: choose ``buckets`` so that one has
    some hundred MB; the number is fixed by the first call. One fold runs at a time. A fold that is cut off leaves
    folders that no version names, and the next call does its work.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    version, held, folded = _version(spark, path)
    if held and max(held) >= buckets:
        raise ValueError(f"{path} has {max(held) + 1} buckets or more")
    new = read_together(spark, changes, log, schema, after=folded)
    reached = dict(folded)
    for run, last in _last_batches(spark, log).items():
        reached[run] = last
    if reached == folded:
        return []
    # The batches up to those just noted; one that is finished meanwhile is left to the next call.
    upto = None
    for run, last in reached.items():
        one = (F.col(RUN) == run) & (F.col(BATCH) <= last)
        upto = one if upto is None else upto | one
    latest = latest_changes(new.where(upto).drop(RUN, BATCH), keys, order_by)
    own = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    target = f"{path}/data/version={version + 1}"
    staged = f"{path}/staged/version={version + 1}"
    # Written by bucket: the touched ones are known from folder names, and the merge reads them by bucket.
    latest.withColumn(BUCKET, own).write.mode("overwrite").partitionBy(BUCKET).parquet(staged)
    touched = spark.read.schema(StructType([*schema.fields]).add(BUCKET, "integer")).parquet(staged)
    numbers = sorted(row[0] for row in touched.select(BUCKET).distinct().collect())
    if numbers:
        before = [held[n] for n in numbers if n in held]
        merged = touched
        if before:
            old = spark.read.schema(schema).parquet(*before).withColumn(BUCKET, own)
            merged = merged.unionByName(old)
        merged = merged.repartition(len(numbers), BUCKET)
        merged = latest_changes(merged, [BUCKET, *keys], order_by)
        merged.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
    held |= {n: f"{target}/{BUCKET}={n}" for n in numbers}
    rows = [("bucket", None, n, folder) for n, folder in sorted(held.items())]
    rows += [("run", run, last, None) for run, last in sorted(reached.items())]
    commits.put(spark.createDataFrame(rows, _ENTRY), f"{path}/versions", _NAME, version + 1)
    return numbers


def _last_batches(spark: SparkSession, log: str) -> dict[str, int]:
    entries = commits.newest(spark, log, "ignored string")
    return {row["name"]: row[commits.NUMBER] for row in entries.collect()} if entries is not None else {}


def folded_rows(spark: SparkSession, path: str, schema: StructType | str, op: str = "op") -> DataFrame:
    """The rows of the newest version that exist, in the columns of the changes."""
    _, held, _ = _version(spark, path)
    if not held:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*(held[n] for n in sorted(held)))
    return rows.where(F.col(op) != F.lit(DELETE))
