"""Templates with variables as rows, and checkpoints that a changed job goes on with."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodewright.operators.templates import render_from_table, resolve_variables
from lodewright.sinks.fanout import Sink
from lodewright.streaming import restart
from lodewright.streaming.jobs import read_sink, start_sinks
from lodewright.streaming.settings import StreamSettings


def _variables(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def test_values_that_name_values(spark):
    rows = [
        ("a", "1${b}${c}"), ("b", "2${c}"), ("c", "3"), ("none", None), (None, "x"), ("far", "${unknown}$ {c} ${"),
        ("x", "${y}"), ("y", "${x}"), ("self", "${self}"), ("to_x", "${c}${x}"), ("c", "2"), ("e", "[${none}]"),
    ]
    found = {r.k: (r.v, r.cyclic) for r in resolve_variables(_variables(spark, rows)).collect()}
    assert found == {
        "a": ("1233", False), "b": ("23", False), "c": ("3", False), "none": ("", False), "e": ("[]", False),
        "far": ("${unknown}$ {c} ${", False), "x": ("${y}", True), "y": ("${x}", True),
        "self": ("${self}", True), "to_x": ("${c}${x}", True),
    }


def test_rendered_by_join_equals_replacing(spark):
    draw = random.Random(5)
    number = 10_000
    rows = [(f"v{i}", f"<{i}>" if draw.random() < 0.5 or i < 10 else f"${{v{i // 10}}}.${{v{i // 3}}}") for i in range(number)]
    values = dict(rows)

    def plain(text):
        for _ in range(40):
            for k in set(__import__("re").findall(r"\$\{(v\d+)\}", text)):
                text = text.replace("${" + k + "}", values.get(k, "${" + k + "}"))
        return text

    texts = ["".join(f"${{v{draw.randrange(number + 50)}}} $x {{}} " for _ in range(draw.randrange(6))) for _ in range(60)]
    texts += ["", None, "$", "${}", "${v1", "${${v1}}"]
    scripts = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "script_id int, text string, k string")
    resolved = resolve_variables(_variables(spark, rows))
    assert not resolved.where("cyclic").count()
    got = render_from_table(scripts, resolved)
    assert got.columns == scripts.columns
    found = {r.script_id: r.text for r in got.collect()}
    assert found == {i: None if t is None else plain(t) for i, t in enumerate(texts)}


def test_one_script_with_every_variable(spark):
    rows = _variables(spark, [(f"v{i}", str(i)) for i in range(10_000)])
    text = "".join(f"${{v{i}}}," for i in range(10_000))
    scripts = spark.createDataFrame([(1, text), (1, "${v7}")], "script_id int, text string")
    found = {r.text for r in render_from_table(scripts, resolve_variables(rows)).collect()}
    assert found == {"".join(f"{i}," for i in range(10_000)), "7"}


def test_empty_tables_of_variables_and_scripts(spark):
    none = resolve_variables(_variables(spark, []))
    scripts = spark.createDataFrame([(None, "${a}"), (2, None)], "script_id int, text string")
    assert sorted(map(str, render_from_table(scripts, none).collect())) == sorted(map(str, scripts.collect()))
    some = resolve_variables(_variables(spark, [("a", "1")]))
    assert render_from_table(scripts.where("false"), some).count() == 0


def test_a_stream_goes_on_with_one_sink_less(spark, tmp_path):
    source, checkpoint = f"{tmp_path}/in", f"{tmp_path}/checkpoint"
    paths = [f"{tmp_path}/even", f"{tmp_path}/odd", f"{tmp_path}/all"]
    sinks = [
        Sink(paths[0], lambda rows: rows.where("id % 2 = 0")),
        Sink(paths[1], lambda rows: rows.where("id % 2 = 1")),
        Sink(paths[2], lambda rows: rows),
    ]

    def run(some, first):
        spark.range(first, first + 10).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id long").parquet(source)
        start_sinks(stream, some, StreamSettings(checkpoint)).awaitTermination()

    def ids(path):
        return sorted(r.id for r in read_sink(spark, path, "id long").collect())

    assert restart.batches(spark, checkpoint).count() == 0
    restart.check_restart(spark, checkpoint, 3, ["any"])
    run(sinks[:2], 0)
    run(sinks[:2], 10)
    restart.check_restart(spark, checkpoint, 1, [])
    run([sinks[0], sinks[2]], 20)
    rows = restart.batches(spark, checkpoint).orderBy("batch_id").collect()
    assert [(r.batch_id, r.source, r.finished) for r in rows] == [(0, 0, True), (1, 0, True), (2, 0, True)]
    assert all("logOffset" in r.offset for r in rows)
    assert ids(paths[0]) == list(range(0, 30, 2))
    assert ids(paths[1]) == list(range(1, 20, 2))
    assert ids(paths[2]) == list(range(20, 30))
    found = restart.left_out(spark, checkpoint, paths[:2], [paths[0], paths[2]]).collect()
    assert {(r.path, r.change, r.last_batch, r.finished_batch) for r in found} == {
        (paths[0], "kept", 2, 2), (paths[1], "dropped", 1, 2), (paths[2], "added", 2, 2),
    }
    with pytest.raises(restart.ChangedJobError):
        restart.check_restart(spark, checkpoint, 2, [])
    with pytest.raises(restart.ChangedJobError):
        restart.check_restart(spark, checkpoint, 1, ["stateStoreSave"])


def test_the_state_of_a_checkpoint(spark, tmp_path):
    checkpoint = f"{tmp_path}/checkpoint"
    spark.range(10).write.parquet(f"{tmp_path}/in")
    counted = spark.readStream.schema("id long").parquet(f"{tmp_path}/in").groupBy(F.col("id") % 3).count()
    query = counted.writeStream.outputMode("complete").foreachBatch(lambda batch, number: batch.count())
    StreamSettings(checkpoint).apply(query).start().awaitTermination()
    rows = restart.states(spark, checkpoint).collect()
    assert [(r.operator, r.store, r.partitions) for r in rows] == [("stateStoreSave", "default", 8)]
    restart.check_restart(spark, checkpoint, 1, ["stateStoreSave"])
    with pytest.raises(restart.ChangedJobError):
        restart.check_restart(spark, checkpoint, 1, [])
    assert restart.states(spark, f"{tmp_path}/nothing").count() == 0
