"""A stream's name, trigger and checkpoint folder."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql.streaming import DataStreamWriter

# The script settings that have a counterpart in Structured Streaming. The state
# backend and the number of tolerated checkpoint failures have none: the default state store is
# in memory with a log in the checkpoint folder, and a failed batch ends the query.
NAME = "pipeline.name"
INTERVAL = "execution.checkpointing.interval"
CHECKPOINTS = "state.checkpoints.dir"
UNITS = {"ms": "milliseconds", "s": "seconds", "min": "minutes", "h": "hours", "d": "days"}


@dataclass(frozen=True)
class StreamSettings:
    """Without an ``interval`` a stream takes all that is there and ends."""

    checkpoint: str
    name: str | None = None
    interval: str | None = None

    def apply(self, writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.option("checkpointLocation", self.checkpoint)
        if self.name:
            writer = writer.queryName(self.name)
        if self.interval:
            return writer.trigger(processingTime=self.interval)
        return writer.trigger(availableNow=True)

    def step(self, number: int) -> StreamSettings:
        """The settings of a query chained to this one, with a checkpoint folder of its own."""
        name = f"{self.name}-{number}" if self.name else None
        return StreamSettings(f"{self.checkpoint.rstrip('/')}/step-{number}", name, self.interval)


def spark_interval(interval: str) -> str:
    """``'10s'`` as ``'10 seconds'``."""
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", interval)
    if not match or match[2] not in UNITS:
        raise ValueError(f"not an interval such as 10s or 5min: {interval!r}")
    return f"{match[1]} {UNITS[match[2]]}"


def settings_from(script_settings: Mapping[str, str]) -> StreamSettings:
    """Stream settings from the ``SET`` statements of a script."""
    interval = script_settings.get(INTERVAL)
    return StreamSettings(
        checkpoint=script_settings[CHECKPOINTS],
        name=script_settings.get(NAME),
        interval=spark_interval(interval) if interval else None,
    )
