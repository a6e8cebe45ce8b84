"""Catalog tables: create, append, and switch to a new version."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def create_table_as(df: DataFrame, table: str, path: str, file_format: str = "parquet") -> None:
    """Write ``df`` to ``path`` and register it as ``table``."""
    df.write.format(file_format).option("path", path).saveAsTable(table)


def insert_select(df: DataFrame, table: str) -> None:
    """Append ``df`` to ``table``, column by name."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table)


def publish(df: DataFrame, table: str, path: str) -> None:
    """Write a new version to the new folder ``path``, then point ``table`` at it.

    Parquet tables know no ``MERGE``, and a table must not be overwritten while it is read: readers
    that started before the switch keep the old files. A partitioned table is refused: its partitions
    have places of their own and would stay; switch them one by one with ``publish_partition``.
    """
    spark = df.sparkSession
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} is partitioned; publish its partitions")
    file_format = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'")
    df.write.format(file_format.first()["data_type"]).mode("errorifexists").save(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def publish_partition(
    spark: SparkSession, table: str, partition: Mapping[str, str], path: str
) -> None:
    """Point one partition of ``table`` at the finished folder ``path``."""
    spec = ", ".join(f"{name} = '{value}'" for name, value in partition.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")
    spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
