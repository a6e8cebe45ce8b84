"""Queries over streams: each runs to the end of its input, then reads what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewright.plans.table_queries import _event_changes
from lodewright.session import shared_dir
from lodewright.sinks.files import TEXT_OPTIONS
from lodewright.sinks.fanout import Sink
from lodewright.sources.files import stream_lines, stream_table, table
from lodewright.streaming.changes import current_rows, start_changes, stream_changes
from lodewright.streaming.jobs import follow, read_sink, start_copy, start_sinks
from lodewright.streaming.settings import StreamSettings

_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def events_copied(spark: SparkSession, folder: str) -> DataFrame:
    """Events to JSON files, every digit of their time kept."""
    path = shared_dir(spark, "copied")
    events = stream_table(spark, folder, "events")
    start_copy(events, f"{path}/rows", StreamSettings(f"{path}/checkpoint")).awaitTermination()
    rows = spark.read.schema(events.schema).options(**TEXT_OPTIONS).json(f"{path}/rows")
    return rows.withColumn("ts", F.date_format("ts", _MICROS))


def events_chained(spark: SparkSession, folder: str) -> DataFrame:
    """A first stream formats the day; a second follows its output."""
    path = shared_dir(spark, "chained")
    settings = StreamSettings(f"{path}/checkpoint")
    dated = stream_table(spark, folder, "events").select(
        "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    start_copy(dated, f"{path}/first", settings.step(1)).awaitTermination()
    copied = follow(spark, f"{path}/first", dated.schema)
    start_copy(copied, f"{path}/second", settings.step(2), "parquet").awaitTermination()
    return spark.read.schema(dated.schema).parquet(f"{path}/second")


def lines_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Document lines from a stream of text files, counted per text."""
    path = shared_dir(spark, "lines")
    text_lines = table(spark, folder, "documents").select(
        F.explode(F.split("text", "\n", -1)).alias("value")
    )
    text_lines.write.text(f"{path}/text")
    lines = stream_lines(spark, f"{path}/text")
    settings = StreamSettings(f"{path}/checkpoint")
    start_copy(lines, f"{path}/rows", settings, "parquet").awaitTermination()
    rows = spark.read.schema(lines.schema).parquet(f"{path}/rows")
    return (
        rows.groupBy(F.md5("value").alias("line_md5"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def fanout_stream(spark: SparkSession, folder: str) -> DataFrame:
    """One stream of events to two sinks, both read back."""
    path = shared_dir(spark, "fanout")
    sinks = [
        Sink(f"{path}/buys", lambda rows: rows.where("event_type = 'purchase'").select("event_id")),
        Sink(
            f"{path}/others",
            lambda rows: rows.where("event_type <> 'purchase'").select("event_id"),
            "json",
        ),
    ]
    events = stream_table(spark, folder, "events")
    start_sinks(events, sinks, StreamSettings(f"{path}/checkpoint")).awaitTermination()
    schema = "event_id bigint"
    buys = read_sink(spark, f"{path}/buys", schema).withColumn("sink", F.lit("buys"))
    others = read_sink(spark, f"{path}/others", schema, "json").withColumn("sink", F.lit("others"))
    return buys.unionByName(others)


def changes_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Change files read as a stream from the earliest one; the rows that exist at the end."""
    path = shared_dir(spark, "changes")
    events = _event_changes(spark, folder)
    events.write.parquet(f"{path}/files")
    changes = stream_changes(spark, f"{path}/files", events.schema)
    settings = StreamSettings(f"{path}/checkpoint")
    keys, order_by = ["id"], ["ts", "seq"]
    start_changes(changes, f"{path}/batches", keys, order_by, settings).awaitTermination()
    rows = current_rows(spark, f"{path}/batches", events.schema, keys, order_by)
    return rows.select("id", "name", "amount", "seq")


QUERIES = {
    "events_copied": events_copied,
    "events_chained": events_chained,
    "lines_streamed": lines_streamed,
    "fanout_stream": fanout_stream,
    "changes_streamed": changes_streamed,
}

ORACLE = {
    "events_copied": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
FROM events""",
    "events_chained": """
SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events""",
    "lines_streamed": """
SELECT md5(line) AS line_md5, count(*) AS copies
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
GROUP BY md5(line)""",
    "fanout_stream": """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'buys' ELSE 'others' END AS sink
FROM events""",
    "changes_streamed": """
SELECT id, name, amount, seq FROM (
    SELECT user_id AS id, event_type AS name, value AS amount, event_id AS seq,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank
    FROM events
) WHERE rank = 1 AND name <> 'error'""",
}
