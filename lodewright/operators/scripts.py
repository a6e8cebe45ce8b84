"""SQL scripts held in a table, one per row: split, render, strip and classify.

Every operator is narrow: a script's statements and variables are found within its own row, so
nothing is shuffled and no script waits for another. All columns besides the text are kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewright.functions import script_text


def _others(scripts: DataFrame, text: str) -> list[str]:
    return [name for name in scripts.columns if name != text]


def each(rows: DataFrame, others: list[str], array: Column, value: str) -> DataFrame:
    """One row per element of ``array``: the columns ``others``, ``pos`` and ``value``.

    The outer generator's row for an empty array is dropped again. For an inner generator Spark
    infers a filter on the array's size, and so computes a costly array a second time.
    """
    exploded = rows.select(*others, F.posexplode_outer(array).alias("pos", value))
    return exploded.where(F.col("pos").isNotNull())


def marked(scripts: DataFrame, text: str = "text") -> DataFrame:
    """The scripts as ``script_text.statements`` and its like read them."""
    return scripts.withColumn(text, script_text.marked(F.col(text)))


def split_statements(scripts: DataFrame, text: str = "text") -> DataFrame:
    """``pos``, ``stmt`` and ``malformed`` for each statement; see ``script_text.statements``."""
    others = _others(scripts, text)
    # In steps: what stands beside a generator in one select is computed once per row it makes.
    read = marked(scripts, text).select(
        *others,
        script_text.malformed(F.col(text)).alias("malformed"),
        script_text.statements(F.col(text)).alias("parts"),
    )
    rows = each(read, [*others, "malformed"], F.col("parts"), "part")
    return rows.select(*others, "pos", "part.stmt", "malformed")


def split_statements_simple(scripts: DataFrame, text: str = "text") -> DataFrame:
    """``pos`` and ``stmt``, split only at semicolons that end a line."""
    parts = script_text.statements_at_line_ends(F.col(text))
    return each(scripts, _others(scripts, text), parts, "stmt")


def extract_variables(scripts: DataFrame, text: str = "text") -> DataFrame:
    """``pos``, ``k`` and ``v`` for each ``set var:`` line."""
    others = _others(scripts, text)
    pairs = each(scripts, others, script_text.variables(F.col(text)), "pair")
    return pairs.select(*others, "pos", "pair.k", "pair.v")


def render_templates(
    scripts: DataFrame, external: Mapping[str, str] | None = None, text: str = "text"
) -> DataFrame:
    """Put the script's own variables, then the ``external`` ones, in place of ``${name}``."""
    own = script_text.variables(F.col(text))
    return scripts.withColumn(text, script_text.rendered(F.col(text), own, external or {}))


def strip_comments(scripts: DataFrame, text: str = "text") -> DataFrame:
    """Remove comments; see ``script_text.without_comments``."""
    return marked(scripts, text).withColumn(text, script_text.without_comments(F.col(text)))


def unwrap_statement_set(scripts: DataFrame, text: str = "text") -> DataFrame:
    """Remove the wrapper of a statement set, leaving its statements."""
    return marked(scripts, text).withColumn(text, script_text.without_statement_set(F.col(text)))


def classify_statements(scripts: DataFrame, text: str = "text") -> DataFrame:
    """``pos``, ``stmt``, ``kind``, ``key``, ``value`` and ``sql_id`` for each statement.

    ``sql_id`` numbers from 1 the statements that would be executed: all but variables. It is counted within the row's array, which saves a shuffle by script.
    """
    others = _others(scripts, text)
    parts = F.transform(
        script_text.statements(F.col(text)),
        lambda part, pos: F.struct(
            pos.alias("pos"),
            part["stmt"].alias("stmt"),
            part["code"].alias("code"),
            script_text.leading_words(part["code"]).alias("lead"),
        ),
    )

    def row(part: Column, sql_id: Column) -> Column:
        return F.struct(
            part["pos"].alias("pos"),
            part["stmt"].alias("stmt"),
            part["code"].alias("code"),
            part["lead"].alias("lead"),
            sql_id.cast("int").alias("sql_id"),
        )

    executed = F.transform(
        F.filter("parts", lambda part: ~script_text.sets_variable(part["lead"])),
        lambda part, index: row(part, index + F.lit(1)),
    )
    variables = F.transform(
        F.filter("parts", lambda part: script_text.sets_variable(part["lead"])),
        lambda part: row(part, F.lit(None)),
    )
    read = marked(scripts, text).select(*others, parts.alias("parts"))
    rows = each(read, others, F.concat(executed, variables), "part").select(*others, "part.*")
    code = F.col("code")
    kinds = rows.withColumn("kind", script_text.statement_kind(code, F.col("lead")))
    key, value = script_text.statement_key_and_value(code, F.col("kind"))
    return kinds.select(
        *others, "pos", "stmt", "kind", key.alias("key"), value.alias("value"), "sql_id"
    )
