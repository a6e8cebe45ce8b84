"""Templates whose variables are rows of a table, however many there are.

A variable's value may name other variables. They are put in first, level by level, over the table of variables;
what names itself by way of others is marked. Each script is then read once: the names it asks for are looked up by
a join, and come back to it as one map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewright.session import shared_dir

_NAMED = r"\$\{([^${}]++)\}"
_TOKEN = r"\$\{[^${}]++\}|[^$]++|\$"


def names_asked(text: Column) -> Column:
    """The distinct names of the ``${name}`` in a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_NAMED), F.lit(1)))


def _filled(text: Column, values: Column) -> Column:
    """The text with the names that ``values`` knows put in, in one scan; what is put in is not read again."""

    def put(token: Column) -> Column:
        name = F.substring(token, F.lit(3), F.length(token) - 3)
        return F.when(token.startswith("${"), F.coalesce(values[name], token)).otherwise(token)

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.when(values.isNull(), text).otherwise(F.array_join(F.transform(tokens, put), ""))


def _written(frame: DataFrame, label: str) -> DataFrame:
    path = shared_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def resolve_variables(variables: DataFrame) -> DataFrame:
    """``(k, v, cyclic)``: each variable with the variables that its value names put in.

    A variable that names itself, also by way of others, or names such a one is ``cyclic`` and keeps its value as
    it was given. A name that no row has stays as ``${name}``. Of rows with one ``k`` that with the largest ``v``
    counts; rows without ``k`` are none, and a null ``v`` is an empty text. The work is one join per level of
    naming, over the variables that wait still and those that became known last.
    """
    rows = variables.where("k is not null").groupBy("k").agg(F.coalesce(F.max("v"), F.lit("")).alias("v"))
    rows = _written(rows, "variables")
    asked = rows.select("k", F.explode(names_asked(F.col("v"))).alias("name"))
    # Who waits for whom; names without a row are waited for by nobody.
    waits = _written(asked.join(rows.select(F.col("k").alias("name")), "name", "left_semi"), "waits")
    known = _written(rows.join(waits.select("k").distinct(), "k", "left_anti"), "known")
    done = last = known
    while True:
        # Ready are those all of whose names are known, one of them since the last level.
        met = waits.join(last.select(F.col("k").alias("name")), "name", "left_semi").select("k").distinct()
        open_names = waits.join(met, "k", "left_semi").join(
            done.select(F.col("k").alias("name"), F.col("v").alias("value")), "name", "left"
        )
        values = open_names.groupBy("k").agg(
            F.count_if(F.col("value").isNull()).alias("missing"),
            F.map_from_entries(
                F.collect_list(F.when(F.col("value").isNotNull(), F.struct("name", "value")))
            ).alias("names"),
        )
        ready = rows.join(values.where("missing = 0"), "k").select("k", _filled(F.col("v"), F.col("names")).alias("v"))
        last = _written(ready, "known")
        if last.isEmpty():
            break
        done = done.unionAll(last)
    marked = done.withColumn("cyclic", F.lit(False))
    left = rows.join(done.select("k"), "k", "left_anti").withColumn("cyclic", F.lit(True))
    return marked.unionAll(left)


def render_from_table(scripts: DataFrame, variables: DataFrame, text: str = "text", key: str = "script_id") -> DataFrame:
    """Put the values of ``resolve_variables`` in place of ``${name}``; unknown and cyclic names stay.

    ``key`` numbers the scripts; rows that repeat a key may have different texts. A null text stays null, all other
    columns are kept. The texts themselves are joined once by key, with the values that they ask for.
    """
    names = scripts.select(F.col(key).alias("_key"), F.explode(names_asked(F.col(text))).alias("k")).distinct()
    values = names.join(variables.where("not cyclic").select("k", "v"), "k")
    maps = values.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("_values"))
    joined = scripts.join(maps, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(text, _filled(F.col(text), F.col("_values"))).select(*scripts.columns)
