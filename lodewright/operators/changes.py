"""Insert, update and delete rows applied to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewright.operators.joins import lookup_join

DELETE = "D"


def latest_changes(changes: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Each key's last change, in the columns of ``changes``.

    An aggregate and not a ranking window: tasks keep one row per key before the shuffle, so a key
    holding a large part of all changes costs no more than any other. Rows equal in ``order_by``
    are decided by their remaining columns, so a retried task gives the same answer.
    """
    rest = [name for name in changes.columns if name not in keys and name not in order_by]
    last = F.max(F.struct(*order_by, *rest)).alias("last")
    return changes.groupBy(*keys).agg(last).select(*keys, "last.*").select(*changes.columns)


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    order_by: list[str],
    op: str = "op",
) -> DataFrame:
    """``target`` after ``changes``, in the target's columns.

    ``target`` holds each key once. The last change of a key replaces the target's row, or removes
    it where ``op`` is ``'D'``; keys new to the target are added. Rows without a change pass an
    anti join only, so a change set that Spark can broadcast leaves the target unshuffled.
    """
    latest = latest_changes(changes, keys, order_by)
    if len(keys) == 1:
        key = keys[0]
        kept = lookup_join(target, changes.select(key).distinct(), key, "left_anti")
    else:
        kept = target.join(changes.select(*keys).distinct(), keys, "left_anti")
    written = latest.where(F.col(op) != F.lit(DELETE)).select(*target.columns)
    return kept.select(*target.columns).unionByName(written)
