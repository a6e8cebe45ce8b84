"""The user functions, as SQL functions that Spark inlines into the plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lodewright.functions.text import SPACE

_FUNCTIONS = {
    "xtrim": f"""(s STRING) RETURNS STRING
        RETURN regexp_replace(nullif(s, ''), r'(?U){SPACE}', '')""",
    "week_of_year": """(d DATE) RETURNS STRING
        RETURN lpad(cast(floor((dayofyear(d) + 6 - weekday(d)) / 7) AS STRING), 2, '0')""",
    "iso_weekday": """(d DATE) RETURNS INT
        RETURN weekday(d) + 1""",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the user functions for this session; returns their names."""
    for name, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(_FUNCTIONS)
