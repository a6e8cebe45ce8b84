"""Codes that carry their own hierarchy in prefixes, flattened to one row per leaf."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewright.functions.text import prefix
from lodewright.operators.joins import lookup_join


def flatten_hierarchy(
    codes: DataFrame,
    province_digits: int = 2,
    city_digits: int = 4,
    code_digits: int = 6,
    provinces: DataFrame | None = None,
    cities: DataFrame | None = None,
) -> DataFrame:
    """``codes(id, name)`` to one row per leaf with its province and city, ordered by ``id``.

    With the default lengths a code ending in ``0000`` is a province, another one ending in
    ``00`` a city, and any other a leaf. A leaf without a city row gets its four-digit prefix
    followed by ``00`` as city code, and its province's name as city name. Ids stay strings, so
    leading zeros and suffix tests hold; the city code is an integer below ten digits and a long up
    to 18. Where ``provinces`` and ``cities`` are at hand as frames of their own, ``codes`` holds
    only leaves and is read once; else it is read for each of the three.
    """
    below_province = "0" * (code_digits - province_digits)
    below_city = "0" * (code_digits - city_digits)
    is_province = F.col("id").endswith(below_province)
    is_leaf = ~F.col("id").endswith(below_city)
    is_city = F.col("id").endswith(below_city) & ~is_province

    leaves = (codes.where(is_leaf) if provinces is None else codes).select(
        "id",
        "name",
        prefix("id", province_digits).alias("province_key"),
        prefix("id", city_digits).alias("city_key"),
    )
    provinces = (codes.where(is_province) if provinces is None else provinces).select(
        prefix("id", province_digits).alias("province_key"),
        F.col("id").alias("province_code"),
        F.col("name").alias("province_name"),
    )
    cities = (codes.where(is_city) if cities is None else cities).select(
        prefix("id", city_digits).alias("city_key"),
        F.col("id").alias("city_id"),
        F.col("name").alias("own_city_name"),
    )
    has_city = F.col("city_id").isNotNull()
    fallback = F.concat(F.col("city_key"), F.lit(below_city))
    number = "int" if code_digits < 10 else "bigint"
    placed = lookup_join(lookup_join(leaves, provinces, "province_key"), cities, "city_key")
    return placed.select(
        "province_code",
        "province_name",
        F.when(has_city, F.col("city_id")).otherwise(fallback).cast(number).alias("city_code"),
        F.when(has_city, F.col("own_city_name"))
        .otherwise(F.col("province_name"))
        .alias("city_name"),
        "id",
        "name",
    ).orderBy("id", "name")


def flatten_levels(
    leaves: DataFrame, groups: DataFrame, digits: Sequence[int], code_digits: int
) -> DataFrame:
    """``leaves(id, name)`` with the groups they are in, for codes of any depth.

    A group of level n is a code whose first ``digits[n - 1]`` digits are its own and the rest zeros, a row of
    ``groups(id, name)``. Each leaf gets, for each level, ``code_n``, its own digits followed by zeros, ``name_n`` and
    ``has_n``, which tells whether that group has a row; where it has none the name is that of the nearest group
    above that has one, and NULL where there is none. A leaf whose digits of a level are zeros is in no group of
    that level, as its code there is that of the level above. Leaves are read once and each counts once; their groups
    are found by one join over all levels, and gathered by an aggregate that is reduced before the shuffle.
    """
    levels = F.array(
        *(
            F.struct(
                F.lit(n).alias("level"),
                F.rpad(prefix("id", size), code_digits, "0").alias("code"),
                F.substring("id", above + 1, size - above).rlike("[^0]").alias("inside"),
            )
            for n, (above, size) in enumerate(zip([0, *digits], digits), 1)
        )
    )
    asked = leaves.select("id", "name", F.explode(levels).alias("at")).select("id", "name", "at.*")
    named = groups.select(F.col("id").alias("code"), F.col("name").alias("group_name"), F.lit(True).alias("found"))
    placed = lookup_join(asked, named, "code")
    columns = []
    for n in range(1, len(digits) + 1):
        own = F.col("level") == n
        known = F.col("found") & F.col("inside") & (F.col("level") <= n)
        columns += [
            F.max(F.when(own, F.col("code"))).alias(f"code_{n}"),
            # max_by passes over rows whose level is NULL.
            F.max_by("group_name", F.when(known, F.col("level"))).alias(f"name_{n}"),
            F.coalesce(F.max(F.when(own, F.col("found") & F.col("inside"))), F.lit(False)).alias(f"has_{n}"),
        ]
    return placed.groupBy("id", "name").agg(*columns)
