"""File sinks, and the job that merges many small files into few."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TARGET_FILE_BYTES = 256 * 1024 * 1024
# Text formats default to milliseconds; these keep every digit of a timestamp. For reading, too.
TEXT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header, in place of what ``path`` held."""
    df.write.mode("overwrite").options(header=True, **TEXT_OPTIONS).csv(path)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``, from the file system's own listing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(
        folder
    ).getLength()


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    file_format: str,
    schema: StructType | str,
    partition: Mapping[str, str] | None = None,
    file_bytes: int = TARGET_FILE_BYTES,
) -> int:
    """Write the rows of the folder ``source`` to ``target`` in files of about ``file_bytes``.

    ``partition`` picks one finished partition, whose columns are left out of the files. Name the
    folder that a stream writes to, not one below it: only there does Spark see the stream's file
    log and pass over files that were never committed. Each task reads several small files and
    writes one, so nothing is shuffled. ``source`` stays as it is, and readers are moved over with
    ``tables.publish_partition``. Returns the number of files.
    """
    rows = spark.read.schema(schema).options(**TEXT_OPTIONS).format(file_format).load(source)
    folder = source
    for name, value in (partition or {}).items():
        rows = rows.where(F.col(name) == F.lit(value)).drop(name)
        folder = f"{folder}/{name}={value}"
    files = max(1, -(-folder_bytes(spark, folder) // file_bytes))
    few = rows.coalesce(files).write.options(**TEXT_OPTIONS)
    few.format(file_format).mode("errorifexists").save(target)
    return files
