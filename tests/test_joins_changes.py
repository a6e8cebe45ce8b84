from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodewright.operators.changes import apply_changes, latest_changes
from lodewright.operators.joins import BROADCAST_ROWS, lookup_join, value_per_key
from lodewright.sinks.tables import create_table_as, publish
from lodewright.streaming.changes import current_rows, fold, start_changes, stream_changes
from lodewright.streaming.settings import StreamSettings


@pytest.fixture
def setting(spark):
    changed = {}

    def change(name, value):
        changed.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _keyed(spark, rows=4000):
    """A third of the rows under one key, some under NULL, some without a value."""
    chance = random.Random(7)
    data = []
    for number in range(rows):
        key = "hot" if chance.random() < 0.34 else chance.choice([None, "a", "b", f"k{number % 50}"])
        value = None if chance.random() < 0.3 or key == "b" else chance.randint(0, 10**6)
        data.append((number, key, chance.randint(0, 100), value))
    return data, spark.createDataFrame(data, "id int, k string, at int, v int")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_value_per_key(spark, setting, adaptive):
    setting("spark.sql.adaptive.enabled", adaptive)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    data, frame = _keyed(spark)
    first = {}
    for number, key, at, value in sorted(data, key=lambda row: (row[2], row[0])):
        if value is not None:
            first.setdefault(key, value)
    result = value_per_key(frame, "k", "v", ["at", "id"], "first_v")
    assert ("_copy" in _plan(result)) == (adaptive == "false")
    rows = sorted(tuple(row) for row in result.select("id", "k", "at", "v", "first_v").collect())
    assert rows == [(*row, first.get(row[1])) for row in data]


def test_a_hot_key_is_split(spark, setting, tmp_path):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4KB")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    facts = spark.range(0, 200_000, 1, 16).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("k")
    )
    lookup = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    joined = lookup_join(facts, lookup, "k")
    joined.write.parquet(str(tmp_path / "rows"))
    counted = joined.groupBy((F.col("k") * 2 == F.col("twice")).alias("right")).count()
    assert [(row.right, row["count"]) for row in counted.collect()] == [(True, 200_000)]
    joined.collect()
    assert "skew=true" in _plan(joined)


def test_only_bounded_sides_are_broadcast(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts, lookup = spark.range(10), spark.range(5).withColumn("x", F.lit(1))
    assert "Broadcast" in _plan(lookup_join(facts, lookup, "id", max_rows=5))
    assert "Broadcast" not in _plan(lookup_join(facts, lookup, "id"))
    assert "Broadcast" not in _plan(lookup_join(facts, lookup, "id", max_rows=BROADCAST_ROWS + 1))


COLUMNS = "op string, seq int, id int, name string"
CHANGES = [
    ("U", 1, 1, "one"), ("U", 5, 1, "one again"), ("D", 3, 1, "one"),
    ("D", 2, 2, "two"), ("U", 4, 9, "nine"), ("D", 6, 8, None), ("U", 7, 3, "three"),
]


def test_apply_changes(spark):
    target = spark.createDataFrame([(2, "b"), (3, "c"), (4, "d")], "id int, name string")
    changes = spark.createDataFrame(CHANGES, COLUMNS)
    result = apply_changes(target, changes, ["id"], ["seq"])
    wanted = [(1, "one again"), (3, "three"), (4, "d"), (9, "nine")]
    assert sorted(map(tuple, result.collect())) == wanted
    again = apply_changes(target, changes.withColumnRenamed("name", "name"), ["id"], ["seq"],
                          )
    assert sorted(map(tuple, again.collect())) == wanted
    assert "left_anti" in _plan(again).lower() or "LeftAnti" in _plan(again)


def test_changes_of_a_hot_key_are_reduced_before_the_shuffle(spark):
    plan = _plan(latest_changes(spark.range(100).selectExpr("id % 3 id", "id seq"), ["id"], ["seq"]))
    assert plan.count("partial_max") == 1 and "Window" not in plan


def test_two_keys_and_tied_order(spark):
    target = spark.createDataFrame([(1, "a", 0), (1, "b", 0)], "x int, y string, v int")
    changes = spark.createDataFrame(
        [(1, "a", 5, "U", 1), (1, "a", 6, "U", 1), (2, "a", 7, "U", 1)],
        "x int, y string, v int, op string, seq int",
    )
    rows = apply_changes(target, changes, ["x", "y"], ["seq"]).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", 6), (1, "b", 0), (2, "a", 7)]


def test_published_versions(spark, tmp_path):
    create_table_as(spark.range(3), "published", str(tmp_path / "v1"))
    before = spark.table("published")
    publish(before.where("id > 0"), "published", str(tmp_path / "v2"))
    assert sorted(row.id for row in spark.table("published").collect()) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "v1")).count() == 3


def test_change_stream(spark, tmp_path):
    files, batches = str(tmp_path / "files"), str(tmp_path / "batches")
    settings = StreamSettings(str(tmp_path / "checkpoint"), "changes")

    def run():
        stream = stream_changes(spark, files, COLUMNS)
        start_changes(stream, batches, ["id"], ["seq"], settings).awaitTermination()
        rows = current_rows(spark, batches, COLUMNS, ["id"], ["seq"])
        return sorted((row.id, row.name) for row in rows.collect())

    spark.createDataFrame(CHANGES[:4], COLUMNS).write.parquet(files)
    assert run() == [(1, "one again")]
    assert run() == [(1, "one again")]
    spark.createDataFrame(CHANGES[4:], COLUMNS).write.mode("append").parquet(files)
    assert run() == [(1, "one again"), (3, "three"), (9, "nine")]

    target = spark.createDataFrame([(2, "b"), (4, "d")], "id int, name string")
    create_table_as(target, "folded", str(tmp_path / "v1"))
    changes = spark.read.schema(COLUMNS).parquet(batches).drop("batch_id")
    fold(spark, "folded", changes, str(tmp_path / "v2"), ["id"], ["seq"])
    assert sorted(map(tuple, spark.table("folded").collect())) == [
        (1, "one again"), (3, "three"), (4, "d"), (9, "nine")
    ]
