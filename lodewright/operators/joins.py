"""How this library joins a large side to a lookup side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sides of at most this many rows (some tens of MB of dates, codes and names) are broadcast.
BROADCAST_ROWS = 200_000
# Copies of the lookup, and so tasks per hot key, where AQE does not split hot keys.
SALTS = 32


def splits_hot_keys(facts: DataFrame) -> bool:
    """Whether AQE will divide a skewed partition of a join of ``facts`` among several tasks."""
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    conf = facts.sparkSession.conf
    return not facts.isStreaming and all(conf.get(name) == "true" for name in names)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "left",
    max_rows: int | None = None,
    null_keys: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` on the column ``on`` (``left``, ``inner`` or ``left_anti``).

    ``max_rows`` is a bound on the lookup that follows from how it was built. Within
    ``BROADCAST_ROWS`` the lookup is broadcast. With no bound, or a larger one, the join is left
    to Spark, which broadcasts by measured size and otherwise shuffles; a hot key is then split
    by AQE, or by a salt where AQE does not (streams, sessions without it). The salt is the number
    of the partition a row is read in: the same on a retry, and it divides even identical rows.
    With ``null_keys`` a NULL key matches a NULL key.
    """
    right = lookup.withColumnRenamed(on, "_on")
    match = F.col(on).eqNullSafe(F.col("_on")) if null_keys else F.col(on) == F.col("_on")
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        joined = facts.join(F.broadcast(right), match, how)
    elif splits_hot_keys(facts):
        joined = facts.join(right, match, how)
    else:
        salted = facts.withColumn("_salt", F.spark_partition_id() % F.lit(SALTS))
        copies = right.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, match & (F.col("_salt") == F.col("_copy")), how)
    return joined.drop("_on", "_salt", "_copy")


def value_per_key(df: DataFrame, key: str, value: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the key's earliest non-null ``value``, on every row of the key.

    Equal to ``first_value(value) OVER (PARTITION BY key ORDER BY (order of non-null values)
    NULLS LAST)`` without bringing all rows of a key to one task: each task first reduces its own
    rows to one per key, and the result is joined back. ``order`` must be unique among a key's
    non-null values; a key without any gets NULL.
    """
    found = (
        df.where(F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.min_by(value, F.struct(*order)).alias(name))
    )
    return lookup_join(df, found, key, null_keys=True)
