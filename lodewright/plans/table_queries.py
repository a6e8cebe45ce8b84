"""Queries over the relational and scalar features, batch sinks and statement lists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodewright.functions.register import register_functions
from lodewright.functions.text import padded, xtrim
from lodewright.operators.changes import apply_changes
from lodewright.operators.joins import lookup_join, value_per_key
from lodewright.plans.steps import run_steps
from lodewright.session import shared_dir
from lodewright.sinks.fanout import Sink, write_sinks
from lodewright.sinks.files import TEXT_OPTIONS, compact, write_csv
from lodewright.sinks.tables import create_table_as, insert_select, publish
from lodewright.sources.files import read_csv, table
from lodewright.sources.rows import inline_rows


def _measured(rows: DataFrame, key: str, trimmed: F.Column) -> DataFrame:
    return rows.select(key, trimmed.alias("trimmed")).select(
        key,
        F.length("trimmed").alias("trimmed_length"),
        F.md5("trimmed").alias("trimmed_md5"),
    )


def xtrim_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents without white space."""
    return _measured(
        table(spark, folder, "documents").select("doc_id", "text"), "doc_id", xtrim("text")
    )


def xtrim_function_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Whole pages without white space, through the registered SQL function."""
    register_functions(spark)
    return _measured(
        table(spark, folder, "pages").select("page_id", "html"),
        "page_id",
        F.expr("xtrim(html)"),
    )


def first_value_per_user(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's first value that is not an error's, on all of the user's events."""
    events = table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )
    return value_per_key(events, "user_id", "value", ["ts", "event_id"], "first_value").drop("ts")


def lineitem_count(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


def lineitem_by_label(spark: SparkSession, folder: str) -> DataFrame:
    """Line items counted per flag, then named by inline rows; one flag has no name."""
    schema = StructType(
        [StructField("l_returnflag", StringType()), StructField("label", StringType())]
    )
    rows = [("R", "returned"), ("A", "accepted")]
    counts = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("items")
    )
    named = lookup_join(counts, inline_rows(spark, rows, schema), "l_returnflag", max_rows=2)
    label = F.when(F.col("label").isNull(), F.lit("none")).otherwise(F.col("label"))
    return named.select("l_returnflag", label.alias("label"), "items")


def order_dates(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.col("o_orderstatus"), F.lit("-"), F.col("o_orderpriority")).alias("status"),
    )


def clock_functions(spark: SparkSession, folder: str) -> DataFrame:
    """The clock only compared, since its value differs from run to run."""
    return table(spark, folder, "events").groupBy("event_type").agg(
        F.count_if(F.col("ts") <= F.localtimestamp()).alias("before_now"),
        F.count_if(F.to_date("ts") <= F.current_date()).alias("until_today"),
        F.count_if(F.year("ts") <= F.year(F.current_date())).alias("until_this_year"),
        F.count_if(F.now() == F.current_timestamp()).alias("same_clock"),
    )


def literals_and_comments(spark: SparkSession, folder: str) -> DataFrame:
    """SQL text with comment marks in literals, nested comments and a partition hint."""
    statement = """
        -- marks inside literals; are text
        SELECT /*+ REBALANCE */ c_custkey, ';' AS semicolon, '-- x' AS dashes, "/* y" AS opened
             , if(c_acctbal < 0, 'owes', 'has') AS state /* nested /* comment ; */ it's */
             , 1 AS b
        FROM {customer} """
    return spark.sql(statement, customer=table(spark, folder, "customer"))


def page_url_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Replace, regular expressions and split on every URL."""
    url = F.col("url")
    return table(spark, folder, "pages").select(
        "page_id",
        F.regexp_extract(url, r"^https?://([^/]+)/", 1).alias("host"),
        F.regexp_replace(url, r"[?#].*$", "").alias("plain"),
        F.replace(url, F.lit("http://"), F.lit("https://")).alias("secure"),
        F.split(url, "/")[3].alias("first_part"),
    )


def _event_changes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("name"),
        F.col("value").alias("amount"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", F.lit("D")).otherwise(F.lit("U")).alias("op"),
    )


def _customer_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("name"),
        F.col("c_acctbal").alias("amount"),
    )


def changes_applied(spark: SparkSession, folder: str) -> DataFrame:
    """Events as changes to the customers: an error deletes, anything else writes."""
    return apply_changes(
        _customer_rows(spark, folder), _event_changes(spark, folder), ["id"], ["ts", "seq"]
    )


def changes_published(spark: SparkSession, folder: str) -> DataFrame:
    """The same into a catalog table, as a new version that the table is switched to."""
    path = shared_dir(spark, "published")
    name = f"lodewright_customers_{uuid.uuid4().hex}"
    create_table_as(_customer_rows(spark, folder), name, f"{path}/v1")
    changes = _event_changes(spark, folder)
    publish(apply_changes(spark.table(name), changes, ["id"], ["ts", "seq"]), name, f"{path}/v2")
    return spark.table(name)


def fanout_batch(spark: SparkSession, folder: str) -> DataFrame:
    """One table of events to two sinks, both read back."""
    path = shared_dir(spark, "fanout")
    sinks = [
        Sink(
            f"{path}/buys",
            lambda rows: rows.where("event_type = 'purchase'").select(
                "event_id", "user_id", "value"
            ),
        ),
        Sink(
            f"{path}/others",
            lambda rows: rows.where("event_type <> 'purchase'").select("event_id", "event_type"),
            "json",
        ),
    ]
    write_sinks(table(spark, folder, "events"), sinks)
    buys = spark.read.parquet(f"{path}/buys").select(
        "event_id", F.lit("purchase").alias("event_type"), F.lit("buys").alias("sink")
    )
    others = (
        spark.read.schema("event_id bigint, event_type string")
        .json(f"{path}/others")
        .withColumn("sink", F.lit("others"))
    )
    return buys.unionByName(others)


def events_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Events in many small JSON files, merged into few."""
    path = shared_dir(spark, "compacted")
    events = table(spark, folder, "events")
    small = events.write.options(maxRecordsPerFile=1000, **TEXT_OPTIONS)
    small.json(f"{path}/small")
    compact(spark, f"{path}/small", f"{path}/large", "json", events.schema)
    return (
        spark.read.schema(events.schema)
        .options(**TEXT_OPTIONS)
        .json(f"{path}/large")
        .withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )


def customers_through_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as CSV and read back with a schema; codes keep their zeros."""
    path = shared_dir(spark, "csv")
    customers = table(spark, folder, "customer").select(
        padded("c_custkey", 8).alias("code"),
        "c_name",
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
    )
    write_csv(customers, path)
    return read_csv(spark, path, customers.schema)


def segment_revenue_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Settings, a database, a table with comments, and INSERTs that run after all other steps."""
    session = spark.newSession()
    path = shared_dir(spark, "steps")
    database = f"lodewright_{uuid.uuid4().hex}"
    init = [
        "SET spark.sql.session.timeZone=UTC",
        f"CREATE DATABASE {database} COMMENT 'one run' LOCATION '{path}'",
        "  ",
        f"USE {database}",
        """CREATE TABLE revenue (segment STRING COMMENT 'market', year INT, orders BIGINT,
               revenue DOUBLE COMMENT 'sum of prices') USING parquet COMMENT 'per year'""",
        "CREATE TABLE markets (segment STRING, label STRING) USING parquet",
    ]
    steps = [
        ("orders", lambda session: table(session, folder, "orders")),
        ("customer", lambda session: table(session, folder, "customer")),
        (
            "priced",
            """SELECT c_mktsegment AS segment, year(o_orderdate) AS year,
                      CAST(o_totalprice AS DECIMAL(18, 2)) AS price
               FROM orders JOIN customer ON o_custkey = c_custkey
               WHERE o_orderstatus <> :excluded""",
        ),
        (
            "summed",
            """SELECT segment, year, count(1) AS orders, CAST(sum(price) AS DOUBLE) AS revenue
               FROM priced WHERE '${x}' <> 'unknown' AND length('p${y}q') = 6
               GROUP BY segment, year""",
        ),
        ("blank", " "),
    ]
    sinks = [
        ("summed", "INSERT INTO revenue SELECT * FROM summed"),
        ("markets", "INSERT INTO markets VALUES ('BUILDING', 'construction; -- all')"),
    ]
    run_steps(session, steps, {"excluded": "P"}, init, sinks)
    insert_select(session.sql("SELECT 'Machines' AS label, 'MACHINERY' AS segment"), "markets")
    return spark.sql(
        f"""SELECT r.segment, m.label, r.year, r.orders, r.revenue
            FROM spark_catalog.{database}.revenue r
            LEFT JOIN spark_catalog.{database}.markets m ON r.segment = m.segment"""
    )


QUERIES = {
    "xtrim_documents": xtrim_documents,
    "xtrim_function_pages": xtrim_function_pages,
    "first_value_per_user": first_value_per_user,
    "lineitem_count": lineitem_count,
    "lineitem_by_label": lineitem_by_label,
    "order_dates": order_dates,
    "clock_functions": clock_functions,
    "literals_and_comments": literals_and_comments,
    "page_url_parts": page_url_parts,
    "changes_applied": changes_applied,
    "changes_published": changes_published,
    "fanout_batch": fanout_batch,
    "events_compacted": events_compacted,
    "customers_through_csv": customers_through_csv,
    "segment_revenue_steps": segment_revenue_steps,
}

_WHITE_SPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{3000}]"
)


def _trimmed(key: str, text: str, source: str) -> str:
    return f"""
SELECT {key}, CAST(length(trimmed) AS INTEGER) AS trimmed_length, md5(trimmed) AS trimmed_md5
FROM (
    SELECT {key}, regexp_replace(nullif({text}, ''), '{_WHITE_SPACE}', '', 'g') AS trimmed
    FROM {source}
)"""


_CHANGES_APPLIED = """
WITH ranked AS (
    SELECT user_id AS id, event_type AS name, value AS amount, event_type = 'error' AS deletes,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank
    FROM events
),
latest AS (SELECT * FROM ranked WHERE rank = 1)
SELECT coalesce(l.id, c.c_custkey) AS id,
       CASE WHEN l.id IS NULL THEN c.c_mktsegment ELSE l.name END AS name,
       CASE WHEN l.id IS NULL THEN c.c_acctbal ELSE l.amount END AS amount
FROM customer c FULL OUTER JOIN latest l ON c.c_custkey = l.id
WHERE l.id IS NULL OR NOT l.deletes"""

ORACLE = {
    "xtrim_documents": _trimmed("doc_id", "text", "documents"),
    "xtrim_function_pages": _trimmed("page_id", "html", "pages"),
    "first_value_per_user": """
WITH valued AS (
    SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN value END AS value
    FROM events
)
SELECT event_id, user_id, value,
       first_value(value) OVER (
           PARTITION BY user_id
           ORDER BY CASE WHEN value IS NULL THEN NULL ELSE ts END NULLS LAST, event_id
       ) AS first_value
FROM valued""",
    "lineitem_count": "SELECT count(1) AS rows FROM lineitem",
    "lineitem_by_label": """
SELECT l_returnflag, coalesce(label, 'none') AS label, count(*) AS items
FROM lineitem
LEFT JOIN (VALUES ('R', 'returned'), ('A', 'accepted')) AS v(flag, label) ON l_returnflag = flag
GROUP BY l_returnflag, label""",
    "order_dates": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       o_orderstatus || '-' || o_orderpriority AS status
FROM orders""",
    "clock_functions": """
SELECT event_type,
       count(*) FILTER (WHERE ts <= CAST(now() AS TIMESTAMP)) AS before_now,
       count(*) FILTER (WHERE CAST(ts AS DATE) <= current_date) AS until_today,
       count(*) FILTER (WHERE year(ts) <= year(current_date)) AS until_this_year,
       count(*) FILTER (WHERE now() = current_timestamp) AS same_clock
FROM events GROUP BY event_type""",
    "literals_and_comments": """
SELECT c_custkey, ';' AS semicolon, '-- x' AS dashes, '/* y' AS opened,
       CASE WHEN c_acctbal < 0 THEN 'owes' ELSE 'has' END AS state, 1 AS b
FROM customer""",
    "page_url_parts": """
SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
       regexp_replace(url, '[?#].*$', '') AS plain,
       replace(url, 'http://', 'https://') AS secure,
       string_split(url, '/')[4] AS first_part
FROM pages""",
    "changes_applied": _CHANGES_APPLIED,
    "changes_published": _CHANGES_APPLIED,
    "fanout_batch": """
SELECT event_id, event_type,
       CASE WHEN event_type = 'purchase' THEN 'buys' ELSE 'others' END AS sink
FROM events""",
    "events_compacted": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
FROM events""",
    "customers_through_csv": """
SELECT lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 8) AS INTEGER), '0') AS code, c_name, c_nationkey, c_acctbal,
       c_mktsegment
FROM customer""",
    "segment_revenue_steps": """
SELECT c_mktsegment AS segment,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'construction; -- all'
                         WHEN 'MACHINERY' THEN 'Machines' END AS label,
       CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus <> 'P'
GROUP BY c_mktsegment, year(o_orderdate)""",
}
