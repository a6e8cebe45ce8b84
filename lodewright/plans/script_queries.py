"""Queries over scripts. Each builds its scripts from whole columns of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewright.operators import scripts
from lodewright.operators.dictionary import ddl_dictionary
from lodewright.operators.templates import render_from_table, resolve_variables
from lodewright.session import shared_dir
from lodewright.sources.files import read_scripts, table

# A session setting: how many tasks the queries here deal their input rows to. Without it the scan decides where it
# has at least as many splits as the session's cores keep busy; a smaller table, whose few row groups would be
# as many tasks' work however many cores there are, is dealt to TASKS_PER_CORE tasks a core.
TASKS = "lodewright.scripts.tasks"
TASKS_PER_CORE = 3


def _rows(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    rows = table(spark, folder, name).select(*columns)
    tasks = int(spark.conf.get(TASKS, "0"))
    if not tasks:
        enough = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        tasks = enough if rows.rdd.getNumPartitions() < enough else 0
    return rows.repartition(tasks) if tasks else rows


_FIELDS = ["table_name", "table_comment", "field_name", "field_comment", "field_type"]


def _literal_text(text: Column) -> Column:
    """Text as the inside of a SQL literal."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(escaped, F.lit("'"), F.lit("''"))


def _joined(*parts: str | Column) -> Column:
    """Plain strings and columns, one after the other."""
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def _measured(statements: DataFrame, *keys: str) -> DataFrame:
    return statements.select(
        *keys, F.length("stmt").alias("stmt_length"), F.md5("stmt").alias("stmt_md5")
    )


def _document_script(text: Column, begin: str, end: str) -> Column:
    """A text as a script with one statement per line."""
    return _joined(begin, F.replace(text, F.lit("\n"), F.lit(f"{end}\n{begin}")), end)


def split_statements_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Separators, quotes and comment marks inside literals, comments and quoted names."""
    script = _document_script(
        _literal_text(F.col("text")),
        "select '",
        ";--/*' as `a;b`, \";\" /* ; it's -- */ ; -- don't; /*",
    )
    documents = _rows(spark, folder, "documents", "doc_id", "text").select(
        "doc_id", script.alias("text")
    )
    return _measured(scripts.split_statements(documents), "doc_id", "pos", "malformed")


def split_statements_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Comments nested five deep, three statements per event."""
    script = _joined(
        "select ", F.col("event_id").cast("string"), " /* 1 /* 2 /* 3 /* 4 /* 5 ; */ */ */ */ it's */;",
        "\n-- only a comment;\nselect '", F.col("event_type"), ";/*' as kind ;select /* /* x; */ */ '",
        F.col("props"), "'",
    )
    events = _rows(spark, folder, "events", "event_id", "event_type", "props").select(
        "event_id", script.alias("text")
    )
    return scripts.split_statements(events)


def split_simple_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A semicolon put behind every line of every document."""
    documents = _rows(spark, folder, "documents", "doc_id", "text").select(
        "doc_id", _document_script(F.col("text"), "", ";").alias("text")
    )
    return _measured(scripts.split_statements_simple(documents), "doc_id", "pos")


def variables_extracted(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every message as a variable."""
    values = F.array_join(
        F.transform(
            F.split("text", "\n", -1),
            lambda line, pos: _joined(
                "SET  var: l", pos.cast("string"), " =  ", line, " ; -- set var: x = 1;"
            ),
        ),
        "\n",
    )
    script = _joined("set var:role=", F.col("role"), ";\n-- set var: off = 1;\n", values)
    messages = _rows(spark, folder, "conversations", "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", script.alias("text")
    )
    return scripts.extract_variables(messages)


def templates_rendered(spark: SparkSession, folder: str) -> DataFrame:
    """Variables that name later ones, external ones, and one that stays unknown."""
    script = _joined(
        "set var: line = ${who} said ${n}\nset var: who = ", F.col("role"),
        ";\nselect '${who}', '${line}', '${missing}', '${n}';\n/* ", F.col("text"), " ${who} */",
    )
    messages = _rows(spark, folder, "conversations", "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", script.alias("text")
    )
    return scripts.render_templates(messages, {"n": "7", "who": "nobody"})


def templates_from_table(spark: SparkSession, folder: str) -> DataFrame:
    """Variables that are rows and name one another; a region that names itself keeps its suppliers' names unknown."""

    def named(name: str, letter: str, key: str, *value: str | Column) -> DataFrame:
        rows = table(spark, folder, name)
        return rows.select(_joined(letter, F.col(key).cast("string")).alias("k"), _joined(*value).alias("v"))

    nation, region = F.col("s_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    itself = F.when(F.col("r_regionkey") == 0, F.lit(" ${r0}")).otherwise(F.lit(""))
    variables = (
        named("part", "p", "p_partkey", F.col("p_name"))
        .unionAll(named("supplier", "s", "s_suppkey", F.col("s_name"), " of ${n", nation, "}"))
        .unionAll(named("nation", "n", "n_nationkey", F.col("n_name"), " in ${r", region, "}"))
        .unionAll(named("region", "r", "r_regionkey", F.col("r_name"), itself))
    )
    part, supplier = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    script = _joined("select '${p", part, "}', '${s", supplier, "}', $1, '${missing}';")
    lines = _rows(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select(
        "l_orderkey", "l_linenumber", script.alias("text")
    )
    return render_from_table(lines, resolve_variables(variables), key="l_orderkey")


def comments_stripped(spark: SparkSession, folder: str) -> DataFrame:
    """Line comments and whole-line blocks go; hints, inline blocks and literals stay."""
    script = _joined(
        "-- head: it's\n/* block\n-- over ", F.col("lang"), "\n */\nselect /*+ coalesce(1) */ '",
        _literal_text(F.col("text")), "--x' /* in line */ -- tail ;\n/* a /* b */ c */",
    )
    documents = _rows(spark, folder, "documents", "doc_id", "lang", "text").select(
        "doc_id", script.alias("text")
    )
    stripped = scripts.strip_comments(documents)
    return stripped.select(
        "doc_id", F.length("text").alias("text_length"), F.md5("text").alias("text_md5")
    )


def statements_classified(spark: SparkSession, folder: str) -> DataFrame:
    """One script of eight statements per order."""
    key = F.col("o_orderkey").cast("string")
    script = _joined(
        "set var: day = ", F.date_format("o_orderdate", "yyyy-MM-dd"), ";\nSET 'job.name' = 'a=",
        key, "';\nadd jar '/jars/", key, ".jar'; -- insert\nselect 'insert into x'; /* insert */;",
        "\nwith s as (select 1) insert into t select ", key, ";from s insert overwrite t select *;",
        "\nINSERT INTO ", F.lower("o_orderstatus"), " values (", key, ");\nset reset",
    )
    orders = _rows(spark, folder, "orders", "o_orderkey", "o_orderdate", "o_orderstatus").select(
        "o_orderkey", script.alias("text")
    )
    return scripts.classify_statements(orders).drop("stmt")


def statement_sets_unwrapped(spark: SparkSession, folder: str) -> DataFrame:
    """The wrapper goes; the END of a CASE before a semicolon stays."""
    key = F.col("o_orderkey").cast("string")
    script = _joined(
        "use d;\nEXECUTE   STATEMENT SET\n BEGIN\ninsert into t select case when ", key,
        " > 1 then 'weekend;' END;\ninsert into u select ", key, "; END ;\nselect 'end';",
    )
    orders = _rows(spark, folder, "orders", "o_orderkey").select(
        "o_orderkey", script.alias("text")
    )
    return scripts.unwrap_statement_set(orders)


def _part_scripts(spark: SparkSession, folder: str) -> DataFrame:
    parts = _rows(spark, folder, "part", "p_partkey", "p_name", "p_type", "p_size")
    return parts.select("p_partkey", _part_ddl().alias("text"))


def _part_ddl() -> Column:
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    return _joined(
        "-- Part;\ncreate table if Not  exists Shop.part_", key, " (\n  id int comment'ID',",
        "\n\tname varchar(", size, ") comment ' ", F.col("p_name"), ", it''s (new); '\n,",
        " price decimal(13, ", size, ") ,tags struct<a: int, b: array<map<string, int>>>\n)",
        " comment '", F.col("p_type"), "' with ('k' = 'v(');\ncreate table c as select f(a, b) from t;",
        "\ninsert into t values (1);\nCREATE TABLE Shop.size_", key, "(Total bigint)",
    )


def ddl_dictionary_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Two tables and five columns declared per part."""
    return ddl_dictionary(_part_scripts(spark, folder)).drop("pos")


def ddl_dictionary_folded(spark: SparkSession, folder: str) -> DataFrame:
    """The same with comments in lower case, as in the dictionary's file."""
    return ddl_dictionary(_part_scripts(spark, folder), fold_case=True).select(*_FIELDS)


def scripts_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as files of INSERT statements, and read back from the statements."""
    path = shared_dir(spark, "scripts")
    line = F.format_string("insert into o values (%d, '%s');", "o_orderkey", "o_orderpriority")
    lines = table(spark, folder, "orders").select(line.alias("value"))
    lines.write.option("maxRecordsPerFile", 5000).text(path)
    statements = scripts.split_statements_simple(read_scripts(spark, path))
    values = r"\((\d+), '(.*)'\)$"
    return statements.select(
        F.regexp_extract("stmt", values, 1).cast("bigint").alias("o_orderkey"),
        F.regexp_extract("stmt", values, 2).alias("o_orderpriority"),
    )


QUERIES = {
    "split_statements_documents": split_statements_documents,
    "split_statements_nested": split_statements_nested,
    "split_simple_documents": split_simple_documents,
    "variables_extracted": variables_extracted,
    "templates_rendered": templates_rendered,
    "templates_from_table": templates_from_table,
    "comments_stripped": comments_stripped,
    "statements_classified": statements_classified,
    "statement_sets_unwrapped": statement_sets_unwrapped,
    "ddl_dictionary_parts": ddl_dictionary_parts,
    "ddl_dictionary_folded": ddl_dictionary_folded,
    "scripts_from_files": scripts_from_files,
}

_LINES = """lines AS (
    SELECT {keys}, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
    FROM {table}
)"""

_DICTIONARY = """
SELECT p_partkey, field_pos, lower(table_name) AS table_name, table_comment, field_name,
       field_comment, field_type
FROM (
    SELECT p_partkey, 0 AS field_pos, 'shop.part_' || p_partkey AS table_name,
           p_type AS table_comment, 'id' AS field_name, 'ID' AS field_comment, 'int' AS field_type
    FROM part
    UNION ALL
    SELECT p_partkey, 1, 'shop.part_' || p_partkey, p_type, 'name',
           p_name || ', it''s (new);', 'varchar(' || p_size || ')' FROM part
    UNION ALL
    SELECT p_partkey, 2, 'shop.part_' || p_partkey, p_type, 'price', '',
           'decimal(13,' || p_size || ')' FROM part
    UNION ALL
    SELECT p_partkey, 3, 'shop.part_' || p_partkey, p_type, 'tags', '',
           'struct<a:int,b:array<map<string,int>>>' FROM part
    UNION ALL
    SELECT p_partkey, 0, 'shop.size_' || p_partkey, '', 'total', '', 'bigint' FROM part
)"""

_SPACES = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

ORACLE = {
    "split_statements_documents": f"""
WITH {_LINES.format(keys="doc_id", table="documents")},
statements AS (
    SELECT doc_id, line_no, CASE WHEN line_no > 0 THEN '-- don''t; /*' || chr(10) ELSE '' END
        || 'select ''' || replace(replace(line, chr(92), chr(92) || chr(92)),
        '''', '''''') || ';--/*'' as `a;b`, ";" /* ; it''s -- */' AS stmt
    FROM lines
)
SELECT doc_id, CAST(line_no AS INTEGER) AS pos, false AS malformed,
       CAST(length(stmt) AS INTEGER) AS stmt_length, md5(stmt) AS stmt_md5
FROM statements""",
    "split_statements_nested": """
SELECT event_id, 0 AS pos,
       'select ' || event_id || ' /* 1 /* 2 /* 3 /* 4 /* 5 ; */ */ */ */ it''s */' AS stmt,
       false AS malformed
FROM events
UNION ALL
SELECT event_id, 1, 'select ''' || event_type || ';/*'' as kind', false FROM events
UNION ALL
SELECT event_id, 2, 'select /* /* x; */ */ ''' || props || '''', false FROM events""",
    "split_simple_documents": f"""
WITH {_LINES.format(keys="doc_id", table="documents")},
trimmed AS (
    SELECT doc_id, line_no, regexp_replace(line, '^{_SPACES}+|{_SPACES}+$', '', 'g') AS stmt
    FROM lines
)
SELECT doc_id,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS INTEGER) AS pos,
       CAST(length(stmt) AS INTEGER) AS stmt_length, md5(stmt) AS stmt_md5
FROM trimmed WHERE stmt <> ''""",
    "variables_extracted": f"""
WITH {_LINES.format(keys="conv_id, turn, role", table="conversations")}
SELECT conv_id, turn, 0 AS pos, 'role' AS k, role AS v FROM conversations
UNION ALL
SELECT conv_id, turn, CAST(line_no + 1 AS INTEGER), 'l' || line_no,
       trim(regexp_replace(line, '{_SPACES}+', ' ', 'g'))
FROM lines""",
    "templates_rendered": """
SELECT conv_id, turn,
       'set var: line = ' || role || ' said 7' || chr(10) || 'set var: who = ' || role || ';'
       || chr(10) || 'select ''' || role || ''', ''' || role || ' said 7'', ''${missing}'', ''7'';'
       || chr(10) || '/* ' || replace(replace(text, '${who}', role), '${n}', '7') || ' ' || role
       || ' */' AS text
FROM conversations""",
    "templates_from_table": """
SELECT l_orderkey, l_linenumber,
       'select ''' || coalesce(p_name, '${p' || l_partkey || '}') || ''', '''
       || CASE WHEN r_regionkey IS NULL OR r_regionkey = 0 THEN '${s' || l_suppkey || '}'
               ELSE s_name || ' of ' || n_name || ' in ' || r_name END
       || ''', $1, ''${missing}'';' AS text
FROM lineitem
LEFT JOIN part ON p_partkey = l_partkey
LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation ON n_nationkey = s_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey""",
    "comments_stripped": """
WITH stripped AS (
    SELECT doc_id, 'select /*+ coalesce(1) */ ''' || replace(replace(text, chr(92),
        chr(92) || chr(92)), '''', '''''') || '--x'' /* in line */' AS text
    FROM documents
)
SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length, md5(text) AS text_md5
FROM stripped""",
    "statements_classified": """
SELECT o_orderkey, pos, kind, key, value, sql_id FROM (
    SELECT o_orderkey, 0 AS pos, 'set_variable' AS kind, 'day' AS key,
           strftime(o_orderdate, '%Y-%m-%d') AS value, CAST(NULL AS INTEGER) AS sql_id FROM orders
    UNION ALL
    SELECT o_orderkey, 1, 'set', 'job.name', 'a=' || o_orderkey, 1 FROM orders
    UNION ALL
    SELECT o_orderkey, 2, 'add_jar', NULL, '/jars/' || o_orderkey || '.jar', 2 FROM orders
    UNION ALL
    SELECT o_orderkey, 3, 'other', NULL, NULL, 3 FROM orders
    UNION ALL
    SELECT o_orderkey, 4, 'insert', NULL, NULL, 4 FROM orders
    UNION ALL
    SELECT o_orderkey, 5, 'insert', NULL, NULL, 5 FROM orders
    UNION ALL
    SELECT o_orderkey, 6, 'insert', NULL, NULL, 6 FROM orders
    UNION ALL
    SELECT o_orderkey, 7, 'set', NULL, NULL, 7 FROM orders
)""",
    "statement_sets_unwrapped": """
SELECT o_orderkey,
       'use d;' || chr(10) || chr(10) || 'insert into t select case when ' || o_orderkey
       || ' > 1 then ''weekend;'' END;' || chr(10) || 'insert into u select ' || o_orderkey
       || '; ' || chr(10) || 'select ''end'';' AS text
FROM orders""",
    "ddl_dictionary_parts": _DICTIONARY,
    "ddl_dictionary_folded": f"""
SELECT table_name, lower(table_comment) AS table_comment, field_name,
       lower(field_comment) AS field_comment, field_type
FROM ({_DICTIONARY})""",
    "scripts_from_files": "SELECT o_orderkey, o_orderpriority FROM orders",
}
