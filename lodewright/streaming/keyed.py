"""Changes in the order of each key, from a stream whose files come in any order.

State holds a row per key: the order of its last change, and whether it is deleted. A change that is older than that,
or repeats it, is passed over; a later one is passed on, with a number that rises by one for each key. What follows
can apply the rows as they come. A deleted key is remembered for a time, so that late changes do not bring it back,
and then forgotten by a timer.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from lodewright.operators.changes import DELETE

VERSION = "version"
# Days that a deleted key is remembered.
DAYS = 7
_STORE = "spark.sql.streaming.stateStore.providerClass"
_STORE_CLASS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_session(spark: SparkSession) -> SparkSession:
    """A session, beside the given one, whose streams keep their state on disk; streams with keyed state need it.

    Timers run out with the next batch that has data: with batches for timers alone, a stream that takes all that
    is there would never end.
    """
    session = spark.newSession()
    session.conf.set(_STORE, _STORE_CLASS)
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return session


class LastChange(StatefulProcessor):
    """Per key the order values of the last change, and whether it deletes. Nulls are lowest."""

    def __init__(self, keys: list[str], order: StructType, rest: list[str], op: str, keep_ms: int):
        self.order = order
        self.names = order.fieldNames()
        self.columns = [*keys, *self.names, *rest]
        self.op, self.keep_ms = op, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = StructType([StructField(f"at_{f.name}", f.dataType) for f in self.order.fields]).add(VERSION, "long")
        self.last = handle.getValueState("last", schema)

    def _rank(self, row) -> tuple:
        return tuple((row[name] is not None, row[name]) for name in self.names)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.last.get() if self.last.exists() else None
        rank = tuple((value is not None, value) for value in tuple(known)[:-1]) if known else None
        newest = None
        for row in rows:
            own = self._rank(row)
            if rank is None or _less(rank, own):
                newest, rank = row, own
        if newest is None:
            return
        version = (tuple(known)[-1] if known else 0) + 1
        self.last.update((*(newest[name] for name in self.names), version))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if newest[self.op] == DELETE:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep_ms)
        yield Row(**{name: newest[name] for name in self.columns}, **{VERSION: version})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def _less(one: tuple, two: tuple) -> bool:
    """Whether a rank is lower; a null is never compared with a value."""
    for (known, a), (given, b) in zip(one, two):
        if known != given:
            return given
        if known and a != b:
            return a < b
    return False


def keyed_changes(
    changes: DataFrame, keys: list[str], order_by: list[str], op: str = "op", keep_days: float = DAYS
) -> DataFrame:
    """The changes that are later than all before them of their key, one per key and batch, with ``version``.

    ``order_by`` tells a key's changes apart: of two with equal values the first one to come counts. Changes of a
    deleted key that come more than ``keep_days`` after its deletion was read are taken as those of a new key. The
    stream runs in a session of ``state_session``. Rows of a key go to one task; where a
    key may have a large part of a batch, reduce batches first, by ``start_changes`` and a stream over what it writes.
    """
    fields = {field.name: field for field in changes.schema.fields}
    rest = [name for name in changes.columns if name not in keys and name not in order_by]
    order = StructType([fields[name] for name in order_by])
    out = StructType([fields[name] for name in [*keys, *order_by, *rest]] + [StructField(VERSION, LongType())])
    processor = LastChange(keys, order, rest, op, int(keep_days * 86_400_000))
    return changes.groupBy(*keys).transformWithState(processor, out, "append", "processingTime")
