from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from lodewright.plans.steps import StepError, preview, run_steps
from lodewright.session import shared_dir
from lodewright.sinks.fanout import Sink, write_sinks
from lodewright.sinks.files import compact, write_csv
from lodewright.sinks.tables import insert_select, publish, publish_partition
from lodewright.sources.files import read_csv, read_lines, read_scripts
from lodewright.sources.rows import generated_rows, generated_stream, inline_rows
from lodewright.streaming.changes import current_rows, start_changes, stream_changes
from lodewright.streaming.jobs import follow, read_sink, start_copy, start_sinks
from lodewright.streaming.settings import StreamSettings, settings_from, spark_interval


def test_scripts_and_lines(spark, tmp_path):
    (tmp_path / "a.sql").write_text("select 1;\nselect '二';\n", encoding="utf-8")
    (tmp_path / "b.sql").write_text("select 3", encoding="utf-8")
    scripts = {row.script_id.rsplit("/", 1)[1]: row.text for row in read_scripts(spark, str(tmp_path)).collect()}
    assert scripts == {"a.sql": "select 1;\nselect '二';\n", "b.sql": "select 3"}
    assert read_lines(spark, str(tmp_path)).count() == 3


def test_csv_keeps_codes_and_checks_headings(spark, tmp_path):
    rows = spark.createDataFrame([("00", 1.5), ("01", None)], "week string, value double")
    write_csv(rows, str(tmp_path / "csv"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "csv"), rows.schema).collect())) == [
        ("00", 1.5), ("01", None)
    ]
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "csv"), "other string, value double").collect()


def test_inline_and_generated_rows(spark):
    rows = inline_rows(spark, [(1, 2), (1, 3), (1, 4)], spark.range(0).selectExpr(
        "int(id) id", "int(id) name").schema)
    assert [tuple(row) for row in rows.collect()] == [(1, 2), (1, 3), (1, 4)]
    made = generated_rows(spark).agg(
        F.min("id"), F.max("id"), F.count("*"), F.min(F.length("name")), F.max(F.length("name"))
    )
    assert tuple(made.first()) == (1, 1000, 1000, 10, 10)
    assert generated_rows(spark).dtypes == [("id", "int"), ("name", "string"), ("ts", "timestamp_ntz")]


def test_generated_stream_ends_at_its_last_row(spark, tmp_path):
    stream = generated_stream(spark, last=5, rows_per_batch=3, batch_millis=100)
    settings = StreamSettings(str(tmp_path / "checkpoint"), "generated", "100 milliseconds")
    query = start_copy(stream, str(tmp_path / "rows"), settings)
    try:
        for _ in range(100):
            if query.lastProgress and query.lastProgress["batchId"] >= 3:
                break
            query.awaitTermination(0.2)
    finally:
        query.stop()
    rows = spark.read.schema(stream.schema).json(str(tmp_path / "rows"))
    assert sorted(row.id for row in rows.collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("reuse", ["scan", "table", "persist"])
def test_sinks(spark, tmp_path, reuse):
    rows = spark.range(10)
    sinks = [
        Sink(str(tmp_path / "even"), lambda rows: rows.where("id % 2 = 0")),
        Sink(str(tmp_path / "odd"), lambda rows: rows.where("id % 2 = 1"), "json"),
    ]
    write_sinks(rows, sinks, reuse)
    write_sinks(rows, sinks, reuse)
    assert spark.read.parquet(str(tmp_path / "even")).count() == 10
    assert spark.read.schema("id bigint").json(str(tmp_path / "odd")).distinct().count() == 5


def test_random_rows_are_shared_between_sinks(spark, tmp_path):
    rows = spark.range(100).withColumn("r", F.rand())
    sinks = [Sink(str(tmp_path / name), lambda rows: rows) for name in ("a", "b")]
    write_sinks(rows, sinks, "table")
    a, b = (spark.read.parquet(sink.path) for sink in sinks)
    assert a.exceptAll(b).count() == 0


def test_streams_on_one_checkpoint_add_no_rows_twice(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path)
    spark.range(20).write.parquet(source)
    settings = StreamSettings(f"{path}/checkpoint")
    sinks = [Sink(f"{path}/low", lambda rows: rows.where("id < 5")),
             Sink(f"{path}/high", lambda rows: rows.where("id >= 5"), "json")]
    for run in range(3):
        if run == 2:
            spark.range(20, 30).write.mode("append").parquet(source)
        stream = follow(spark, source, "id bigint", "parquet")
        start_sinks(stream, sinks, settings.step(1)).awaitTermination()
        start_copy(stream, f"{path}/copy", settings.step(2)).awaitTermination()
        chained = follow(spark, f"{path}/copy", "id bigint")
        start_copy(chained, f"{path}/chained", settings.step(3), "parquet").awaitTermination()
        total = 30 if run == 2 else 20
        assert read_sink(spark, f"{path}/low", "id bigint").count() == 5
        assert read_sink(spark, f"{path}/high", "id bigint", "json").count() == total - 5
        assert spark.read.parquet(f"{path}/chained").count() == total


def test_compacted_partition_of_a_table(spark, tmp_path):
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    rows = spark.range(1000).selectExpr("id", "if(id < 600, '2024-01-01', '2024-01-02') AS day")
    rows.repartition(40).write.partitionBy("day").json(small)
    spark.sql(f"CREATE TABLE days (id BIGINT, day STRING) USING json PARTITIONED BY (day) LOCATION '{small}'")
    spark.sql("MSCK REPAIR TABLE days")
    day = {"day": "2024-01-01"}
    files = compact(spark, small, large, "json", "id bigint, day string", day)
    assert files == 1 and len(list((tmp_path / "large").glob("part-*"))) == 1
    publish_partition(spark, "days", day, large)
    counts = spark.table("days").groupBy("day").agg(F.count("*"), F.sum("id")).orderBy("day")
    assert [tuple(row) for row in counts.collect()] == [
        ("2024-01-01", 600, 179700), ("2024-01-02", 400, 319800)
    ]
    assert len(spark.table("days").where("day = '2024-01-01'").inputFiles()) == 1


def test_settings():
    script = {"pipeline.name": "demo", "execution.checkpointing.interval": "10s",
              "state.checkpoints.dir": "s3a://bucket/ckp", "state.backend": "hashmap"}
    assert settings_from(script) == StreamSettings("s3a://bucket/ckp", "demo", "10 seconds")
    assert spark_interval("5min") == "5 minutes"
    with pytest.raises(ValueError):
        spark_interval("soon")


def test_steps(spark, tmp_path):
    session = spark.newSession()
    init = [f"CREATE DATABASE steps LOCATION '{tmp_path}/db'", "USE steps",
            "CREATE TABLE t (id BIGINT COMMENT 'key', name STRING) USING parquet COMMENT 'a table'",
            "CREATE TABLE ids (id BIGINT) USING parquet"]
    steps = [
        ("numbers", lambda session: session.range(4)),
        ("named", "SELECT id, concat('n', id) AS name FROM numbers WHERE id >= :low"),
        ("", "  \n"),
        ("seen", "SELECT count(1) AS rows FROM t"),
        ("tables", "SHOW TABLES"),
    ]
    sinks = [
        ("both", "FROM named INSERT INTO t SELECT id, name INSERT INTO ids SELECT id"),
        ("t", "INSERT INTO t VALUES (9, 'nine')"),
    ]
    results = run_steps(session, steps, {"low": 2}, init, sinks)
    assert "t" in [row.tableName for row in results["tables"].collect()]
    insert_select(session.sql("SELECT 'ten' AS name, 10L AS id"), "t")
    rows = session.table("spark_catalog.steps.t").orderBy("id").collect()
    assert [tuple(row) for row in rows] == [(2, "n2"), (3, "n3"), (9, "nine"), (10, "ten")]
    assert sorted(row.id for row in session.table("ids").collect()) == [2, 3]
    assert preview(session.range(100)).count() == 20
    assert spark.catalog.currentDatabase() == "default"
    with pytest.raises(StepError, match="step wrong failed: SELECT x FROM nowhere") as caught:
        run_steps(session, [("wrong", "SELECT x FROM nowhere")])
    assert caught.value.__cause__ is not None
    with pytest.raises(StepError, match="init statement 1 failed"):
        run_steps(session, [], init=["NONSENSE"])


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base.rstrip("/") + "/lodewright/x-")


def test_unknown_names_in_braces_stay(spark):
    found = run_steps(spark, [("kept", "SELECT '${x}' AS a, 'p${y}q' AS b")])
    assert tuple(found["kept"].first()) == ("${x}", "p${y}q")


def test_publish_refuses_partitioned_tables(spark, tmp_path):
    name = f"parted_{uuid.uuid4().hex}"
    rows = spark.range(3).withColumn("day", F.lit("a"))
    rows.write.partitionBy("day").option("path", str(tmp_path / "v1")).saveAsTable(name)
    with pytest.raises(ValueError, match="partitioned"):
        publish(spark.table(name).where("id > 1"), name, str(tmp_path / "v2"))
    spark.sql(f"DROP TABLE {name}")


def test_a_backlog_is_worked_off_in_batches(spark, tmp_path):
    rows = spark.range(40).selectExpr("id % 5 AS id", "id AS seq", "'U' AS op")
    rows.repartition(4).write.parquet(str(tmp_path / "files"))
    changes = stream_changes(spark, str(tmp_path / "files"), rows.schema, max_files=1)
    settings = StreamSettings(str(tmp_path / "checkpoint"))
    query = start_changes(changes, str(tmp_path / "batches"), ["id"], ["seq"], settings)
    query.awaitTermination()
    assert len(list((tmp_path / "batches").glob("batch_id=*"))) == 4
    last = current_rows(spark, str(tmp_path / "batches"), rows.schema, ["id"], ["seq"])
    assert sorted((r.id, r.seq) for r in last.collect()) == [(i, 35 + i) for i in range(5)]


def test_finished_partition_of_a_stream_is_compacted(spark, tmp_path):
    rows = spark.range(40).selectExpr("id", "CAST(id % 2 AS STRING) AS day")
    rows.repartition(4).write.parquet(str(tmp_path / "source"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "source"))
    path = str(tmp_path / "rows")
    settings = StreamSettings(str(tmp_path / "checkpoint"))
    start_copy(stream, path, settings, "parquet", ["day"]).awaitTermination()
    files = compact(spark, path, str(tmp_path / "day1"), "parquet", rows.schema, {"day": "1"})
    assert files == 1
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "day1")).collect()) == list(range(1, 40, 2))


def test_compacting_a_stream_passes_over_uncommitted_files(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "rows")
    spark.range(30).write.parquet(source)
    stream = follow(spark, source, "id bigint", "parquet")
    start_copy(stream, path, StreamSettings(str(tmp_path / "checkpoint"))).awaitTermination()
    (tmp_path / "rows" / "part-left-over.json").write_text('{"id": 999}\n')
    compact(spark, path, str(tmp_path / "few"), "json", "id bigint")
    rows = spark.read.schema("id bigint").json(str(tmp_path / "few"))
    assert sorted(row.id for row in rows.collect()) == list(range(30))
