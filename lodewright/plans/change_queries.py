"""Queries over tables that follow change streams, sinks that appear together, and files merged in the background."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewright.plans.stream_queries import ORACLE as STREAMS
from lodewright.plans.table_queries import _event_changes
from lodewright.session import shared_dir
from lodewright.sinks.compaction import plan, read_merged, run
from lodewright.sinks.fanout import Sink, read_together
from lodewright.sinks.files import TEXT_OPTIONS
from lodewright.sources.files import stream_table, table
from lodewright.sources.lines import numbered_lines
from lodewright.streaming.changes import start_changes, stream_changes
from lodewright.streaming.folded import fold_new, folded_rows
from lodewright.streaming.jobs import follow, read_sink, start_copy, start_sinks
from lodewright.streaming.keyed import VERSION, keyed_changes, state_session
from lodewright.streaming.restart import check_restart, left_out
from lodewright.streaming.settings import StreamSettings

_KEYS, _ORDER = ["id"], ["ts", "seq"]


def changes_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Change files in no order, in two batches with a restart between; the last row that each key's state passed on."""
    session = state_session(spark)
    path = shared_dir(spark, "keyed")
    events = _event_changes(session, folder)
    settings = StreamSettings(f"{path}/checkpoint")
    for part in (0, 1):
        # The files of the first part hold changes that are later than some of the second.
        some = events.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == part)
        some.write.mode("append").parquet(f"{path}/files")
        changes = stream_changes(session, f"{path}/files", events.schema)
        start_changes(changes, f"{path}/reduced", _KEYS, _ORDER, settings.step(1)).awaitTermination()
        reduced = follow(session, f"{path}/reduced", events.schema, "parquet")
        passed = keyed_changes(reduced, _KEYS, _ORDER)
        start_copy(passed, f"{path}/passed", settings.step(2), "parquet").awaitTermination()
    rows = spark.read.schema(passed.schema).parquet(f"{path}/passed")
    last = rows.groupBy("id").agg(F.max_by(F.struct("name", "amount", "seq", "op"), VERSION).alias("last"))
    return last.where("last.op <> 'D'").select("id", "last.name", "last.amount", "last.seq")


def changes_folded(spark: SparkSession, folder: str) -> DataFrame:
    """Changes that come in two parts, each folded into a table of buckets as it comes."""
    path = shared_dir(spark, "folded")
    events = _event_changes(spark, folder)
    settings = StreamSettings(f"{path}/checkpoint")
    for part in (0, 1):
        events.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == part).write.mode("append").parquet(f"{path}/files")
        changes = stream_changes(spark, f"{path}/files", events.schema)
        log = f"{path}/log"
        start_changes(changes, f"{path}/batches", _KEYS, _ORDER, settings, log).awaitTermination()
        fold_new(spark, f"{path}/table", f"{path}/batches", log, events.schema, _KEYS, _ORDER, buckets=8)
    return folded_rows(spark, f"{path}/table", events.schema).select("id", "name", "amount", "seq")


def stream_restarted(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of events to two sinks, started again with one sink less when half of the events are through."""
    path, schema = shared_dir(spark, "restarted"), "event_id bigint, event_type string"
    buys = Sink(f"{path}/buys", lambda rows: rows.where("event_type = 'purchase'").select("event_id"))
    others = Sink(f"{path}/others", lambda rows: rows.where("event_type <> 'purchase'").select("event_id"))
    settings = StreamSettings(f"{path}/checkpoint")
    events = table(spark, folder, "events").select("event_id", "event_type")
    for part, sinks in ((0, [buys, others]), (1, [buys])):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{path}/files")
        check_restart(spark, settings.checkpoint, sources=1, operators=[])
        start_sinks(follow(spark, f"{path}/files", schema, "parquet"), sinks, settings).awaitTermination()
    report = left_out(spark, settings.checkpoint, [buys.path, others.path], [buys.path])
    rows = [
        read_sink(spark, sink.path, "event_id bigint").withColumn("path", F.lit(sink.path)) for sink in (buys, others)
    ]
    return rows[0].unionAll(rows[1]).join(report, "path").select(
        "event_id",
        F.element_at(F.split("path", "/"), -1).alias("sink"),
        "change",
        (F.col("finished_batch") - F.col("last_batch")).alias("batches_missed"),
    )


def fanout_together(spark: SparkSession, folder: str) -> DataFrame:
    """One stream of events to two sinks that appear together, read by their log."""
    path = shared_dir(spark, "together")
    schema = "event_id bigint"
    sinks = [
        Sink(f"{path}/buys", lambda rows: rows.where("event_type = 'purchase'").select("event_id")),
        Sink(f"{path}/others", lambda rows: rows.where("event_type <> 'purchase'").select("event_id"), "json"),
    ]
    events = stream_table(spark, folder, "events")
    start_sinks(events, sinks, StreamSettings(f"{path}/checkpoint"), f"{path}/log").awaitTermination()
    buys = read_together(spark, f"{path}/buys", f"{path}/log", schema)
    others = read_together(spark, f"{path}/others", f"{path}/log", schema, "json")
    return buys.select("event_id", F.lit("buys").alias("sink")).unionByName(
        others.select("event_id", F.lit("others").alias("sink"))
    )


def days_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """A stream's folders by day, of many small files: those of finished days merged in one job, all rows read."""
    path = shared_dir(spark, "days")
    events = stream_table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    settings = StreamSettings(f"{path}/checkpoint")
    small = events.repartition(4, "event_id")
    start_copy(small, f"{path}/small", settings, partition_by=["day"]).awaitTermination()
    for last in ("2024-01-10", "2024-01-29"):
        wanted = plan(spark, f"{path}/small", f"{path}/merged", ["day"], F.col("day") < last)
        run(spark, wanted, f"{path}/small", f"{path}/merged", "json", events.schema, ["day"])
    rows = read_merged(spark, f"{path}/small", f"{path}/merged", "json", events.schema, ["day"])
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def lines_numbered(spark: SparkSession, folder: str) -> DataFrame:
    """Document lines in text files that are read in several splits, each with its number in its file."""
    path = shared_dir(spark, "numbered")
    lines = table(spark, folder, "documents").select(
        F.expr("doc_id div 500").alias("part"), "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "value")
    )
    ordered = lines.repartition("part").sortWithinPartitions("part", "doc_id", "pos").select("part", "value")
    ordered.write.partitionBy("part").text(f"{path}/text")
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    numbered = numbered_lines(session, f"{path}/text", parts=["part"])
    rows = numbered.select(F.col("part").cast("long").alias("part"), "line_no", F.md5("value").alias("line_md5"))
    kept = f"{path}/numbered"
    rows.write.parquet(kept)
    return spark.read.schema(rows.schema).parquet(kept)


QUERIES = {
    "changes_keyed": changes_keyed,
    "changes_folded": changes_folded,
    "stream_restarted": stream_restarted,
    "fanout_together": fanout_together,
    "days_compacted": days_compacted,
    "lines_numbered": lines_numbered,
}

ORACLE = {
    "changes_keyed": STREAMS["changes_streamed"],
    "changes_folded": STREAMS["changes_streamed"],
    "stream_restarted": """
SELECT event_id, 'buys' AS sink, 'kept' AS change, CAST(0 AS BIGINT) AS batches_missed
FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, 'others', 'dropped', CAST(1 AS BIGINT)
FROM events WHERE event_type <> 'purchase' AND event_id % 2 = 0""",
    "fanout_together": STREAMS["fanout_stream"],
    "days_compacted": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props,
       strftime(ts, '%Y-%m-%d') AS day
FROM events""",
    "lines_numbered": """
WITH lines AS (
    SELECT doc_id // 500 AS part, doc_id, string_split(text, chr(10)) AS all_lines FROM documents
), numbered AS (
    SELECT part, doc_id, unnest(all_lines) AS value, unnest(range(len(all_lines))) AS pos FROM lines
)
SELECT part, row_number() OVER (PARTITION BY part ORDER BY doc_id, pos) AS line_no, md5(value) AS line_md5
FROM numbered""",
}
