"""Merging the small files of a running stream's finished folders, all in one job, with a log of what is merged.

The stream's folders stay as they are: readers go by the log, which names the merged folder of each finished one. A
folder that is merged is not merged again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodewright.session import shared_dir
from lodewright.sinks import commits
from lodewright.sinks.files import TARGET_FILE_BYTES, TEXT_OPTIONS
from lodewright.sinks.tables import publish_partition

_NAME = "merged"
_RUN = "run_number"


def listed_files(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """``(path, length)`` and the folder columns, as text, of the files that a reader of ``path`` sees.

    For the output of a stream these are the files of its log. Only names and sizes are read.
    """
    rows = spark.read.format("binaryFile").load(path)
    return rows.select("path", "length", *(F.col(name).cast("string") for name in parts))


def merged_folders(spark: SparkSession, target: str, parts: Sequence[str]) -> DataFrame:
    """What is merged: the folder columns, as text, the ``run`` that did it, and the ``files`` that it read."""
    schema = ", ".join([*(f"`{name}` string" for name in parts), "run long", "files long"])
    entry = commits.newest(spark, f"{target}/merges", schema)
    if entry is None:
        return spark.createDataFrame([], schema)
    return entry.select(*parts, "run", "files")


def plan(
    spark: SparkSession,
    source: str,
    target: str,
    parts: Sequence[str],
    finished: Column,
    file_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """The finished folders of ``source`` worth merging: their columns, ``files``, ``bytes`` and ``bins`` to make.

    ``finished`` is a condition on the folder columns that holds where no more files come. Folders that are merged, or
    have no more files than bins, are left out. A merged folder that got files since is an error: readers would
    not see them.
    """
    folders = listed_files(spark, source, parts).groupBy(*parts).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    path = shared_dir(spark, "folders")
    folders.write.parquet(path)
    folders = spark.read.schema(folders.schema).parquet(path)
    done = merged_folders(spark, target, parts)
    same = [F.col(f"f.{name}").eqNullSafe(F.col(f"d.{name}")) for name in parts]
    late = folders.alias("f").join(done.alias("d"), [*same, F.col("f.files") != F.col("d.files")], "left_semi").first()
    if late is not None:
        raise ValueError(f"a merged folder has new files: {late}")
    todo = folders.where(finished).withColumn(
        "bins", F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes)).cast("int")
    )
    return todo.where("files > bins").alias("f").join(done.alias("d"), same, "left_anti")


def run(
    spark: SparkSession,
    wanted: DataFrame,
    source: str,
    target: str,
    file_format: str,
    schema: StructType | str,
    parts: Sequence[str],
) -> int | None:
    """Merge the folders of a ``plan`` in one job; returns the run's number, None if there was nothing to do.

    Rows go to bins by the file they come from, so a bin holds whole files and a folder's bins are alike in size; only
    planned folders are read and moved. What a run writes appears together, by the log's next entry; a run that
    fails leaves files that no entry names, and the next run overwrites them. One run is at work at a time.
    """
    number = _last_run(spark, target) + 1
    total = wanted.agg(F.sum("bins")).first()[0]
    if not total:
        return None
    rows = _source(spark, source, file_format, schema, parts)
    names = [name for name in rows.columns if name not in parts]
    keyed = rows.select("*", F.col("_metadata.file_path").alias("_file")).alias("r")
    same = [F.col(f"r.{name}").eqNullSafe(F.col(f"w.{name}")) for name in parts]
    binned = keyed.join(wanted.alias("w"), same).select(
        *(F.col(f"r.{name}") for name in [*names, *parts]),
        F.pmod(F.xxhash64("r._file"), F.col("w.bins")).alias("_bin"),
    )
    dealt = binned.repartition(int(total), *parts, "_bin").drop("_bin")
    writer = dealt.write.mode("overwrite").options(**TEXT_OPTIONS).partitionBy(*parts)
    writer.format(file_format).save(f"{target}/data/{_RUN}={number}")
    made = wanted.select(*parts, F.lit(number).cast("long").alias("run"), "files")
    commits.put(merged_folders(spark, target, parts).unionByName(made), f"{target}/merges", _NAME, number)
    return number


def read_merged(
    spark: SparkSession, source: str, target: str, file_format: str, schema: StructType | str, parts: Sequence[str]
) -> DataFrame:
    """All rows of ``source``: those of merged folders from their merged files, the others from their own.

    The folder columns come as text. Folders are picked by their names before any file is opened.
    """
    merged = merged_folders(spark, target, parts).select(_key(parts).alias("key")).collect()
    rest = _source(spark, source, file_format, schema, parts)
    if not merged:
        return rest
    rest = rest.where(~_key(parts).isin([row.key for row in merged]))
    done = _source(spark, f"{target}/data", file_format, schema, [_RUN, *parts])
    done = done.where(F.col(_RUN).cast("long") <= _last_run(spark, target))
    return rest.unionByName(done.drop(_RUN))


def publish_merged(
    spark: SparkSession, table: str, target: str, parts: Sequence[str], number: int
) -> None:
    """Point the partitions of ``table`` that the run ``number`` merged at their new folders."""
    path = f"{target}/data/{_RUN}={number}"
    folders = listed_files(spark, path, parts).select(*parts, F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    for row in folders.distinct().collect():
        publish_partition(spark, table, {name: row[name] for name in parts}, row.folder)


def retired(spark: SparkSession, source: str, target: str, parts: Sequence[str]) -> DataFrame:
    """``(path, length)`` and the folder columns of the source's files that no reader of the log needs any more."""
    same = [F.col(f"f.{name}").eqNullSafe(F.col(f"d.{name}")) for name in parts]
    files = listed_files(spark, source, parts).alias("f")
    return files.join(merged_folders(spark, target, parts).alias("d"), same, "left_semi")


def _source(
    spark: SparkSession, path: str, file_format: str, schema: StructType | str, parts: Sequence[str]
) -> DataFrame:
    full = StructType.fromDDL(schema) if isinstance(schema, str) else StructType([*schema.fields])
    full = StructType([field for field in full.fields if field.name not in parts])
    for name in parts:
        full = full.add(name, "string")
    return spark.read.schema(full).options(**TEXT_OPTIONS).format(file_format).load(path)


def _key(parts: Sequence[str]) -> Column:
    return F.concat_ws("\x01", *(F.coalesce(F.col(name), F.lit("\x02")) for name in parts))


def _last_run(spark: SparkSession, target: str) -> int:
    """The last finished run's number, -1 before the first."""
    entry = commits.newest(spark, f"{target}/merges", "run long")
    last = entry.agg(F.max(commits.NUMBER)).first()[0] if entry is not None else None
    return -1 if last is None else last
