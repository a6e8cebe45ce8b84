"""A job as a list of named statements."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Step = str | Callable[[SparkSession], DataFrame]

_SUBSTITUTE = "spark.sql.variable.substitute"
_PARAMETER = re.compile(r"(?<![:\w]):[A-Za-z_]\w*")


class StepError(RuntimeError):
    """A statement failed; the message names it and the cause is chained."""


def run_steps(
    spark: SparkSession,
    steps: Iterable[tuple[str, Step]],
    args: Mapping[str, Any] | None = None,
    init: Iterable[str] = (),
    sinks: Iterable[tuple[str, str]] = (),
) -> dict[str, DataFrame]:
    """Run ``init`` statements, then ``steps`` in order, then ``sinks`` (the ``INSERT``s).

    A step is SQL text, with ``:name`` for values of ``args``, or a function of the session. Its
    result becomes the temporary view of its name, so that later steps can read it; queries stay
    lazy. Blank statements are passed over. The session stays open. Returns the steps' results.
    """
    for number, statement in enumerate(init, 1):
        _run(spark, f"init statement {number}", statement, args)
    results = {}
    for name, step in steps:
        result = _run(spark, f"step {name}", step, args)
        if result is not None:
            result.createOrReplaceTempView(name)
            results[name] = result
    for name, statement in sinks:
        _run(spark, f"sink {name}", statement, args)
    return results


def _run(
    spark: SparkSession, label: str, step: Step, args: Mapping[str, Any] | None
) -> DataFrame | None:
    if isinstance(step, str) and not step.strip():
        return None
    try:
        if callable(step):
            return step(spark)
        uses_args = args and _PARAMETER.search(step)
        before = spark.conf.get(_SUBSTITUTE)
        spark.conf.set(_SUBSTITUTE, "false")  # else an unknown ${x} would vanish
        try:
            return spark.sql(step, args=dict(args)) if uses_args else spark.sql(step)
        finally:
            spark.conf.set(_SUBSTITUTE, before)
    except Exception as error:
        text = step if isinstance(step, str) else getattr(step, "__name__", repr(step))
        raise StepError(f"{label} failed: {text}") from error


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows, for show."""
    return df.limit(rows)
