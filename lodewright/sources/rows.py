"""Rows made by Spark itself: inline values and generated sequences."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def inline_rows(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """A few rows as a local relation, whose size Spark knows when it plans a join."""
    arrow_schema = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema)


def _generated(ids: DataFrame, name_length: int) -> DataFrame:
    return ids.select(
        F.col("id").cast("int").alias("id"),
        F.randstr(F.lit(name_length)).alias("name"),
        F.localtimestamp().alias("ts"),
    )


def generated_rows(
    spark: SparkSession, first: int = 1, last: int = 1000, name_length: int = 10
) -> DataFrame:
    """``id`` from ``first`` to ``last``, a random ``name``, and ``ts`` of the query's start."""
    return _generated(spark.range(first, last + 1), name_length)


def generated_stream(
    spark: SparkSession,
    first: int = 1,
    last: int = 1000,
    name_length: int = 10,
    rows_per_batch: int = 2,
    batch_millis: int = 1000,
) -> DataFrame:
    """The same rows as a stream of ``rows_per_batch`` rows every ``batch_millis``.

    The rate source itself never ends; after ``last`` the stream gives no more rows and the
    caller stops the query.
    """
    rate = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("advanceMillisPerBatch", batch_millis)
        .load()
    )
    ids = rate.select((F.col("value") + F.lit(first)).alias("id")).where(F.col("id") <= last)
    return _generated(ids, name_length)
