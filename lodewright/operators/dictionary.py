"""A data dictionary from ``CREATE TABLE`` text: one row per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewright.functions import script_text
from lodewright.functions.script_text import BACK_QUOTED, DOUBLE_QUOTED, QUOTED, SINGLE_QUOTED
from lodewright.functions.text import ANY_SPACE, collapse_spaces, strip
from lodewright.operators.scripts import each, marked

# The dictionary's columns and the headings of its CSV file.
HEADINGS = {
    "table_name": "表名",
    "table_comment": "表描述",
    "field_name": "字段名",
    "field_comment": "字段描述",
    "field_type": "字段类型",
}

# Of a trimmed statement whose white space isn't collapsed yet, so that only these statements' is.
_CREATE_TABLE = rf"(?i)^create{ANY_SPACE}++table\b"
_HEAD = rf"^(?:[^('\"`]++|{QUOTED})*+"
_NAME = rf"(?:{BACK_QUOTED}|[^\s`]++)++"
_TABLE_NAME = rf"(?i)^create table (?:if not exists )?({_NAME})"
_COMMENT = rf"(?i)\bcomment ?=? ?({SINGLE_QUOTED}(?:{SINGLE_QUOTED})*+|{DOUBLE_QUOTED})"
# What surrounds a column list, unit by unit: a bracket or a quoted text is passed over whole.
_INNER = rf"[^()'\"`]++|{QUOTED}"
_BRACKET = rf"\((?:{_INNER}|\((?:{_INNER}|\((?:{_INNER})*+\))*+\))*+\)"
_AROUND = rf"(?i)\A(?:[^('\"`]|{QUOTED}|{_BRACKET})*?"
_TABLE_COMMENT = _AROUND + _COMMENT.removeprefix("(?i)")
_PARTITIONED = rf"{_AROUND}\bpartitioned by ?({_BRACKET})"

_TYPE_WORD = r"(?i:array|map|struct|row|multiset) ?"
_NESTED_TYPE = rf"\b{_TYPE_WORD}\z"
# Brackets that are read by pattern, with how many others inside each other; what nests deeper is folded.
_NATIVE = 4
_FLAT = r"\([^()'\"`]*+\)"


def _round(depth: int) -> str:
    """Balanced brackets. Beside brackets that hold no others there is no ``<`` or ``>``, so no type opens or closes."""
    inner = f"{_FLAT}|{_round(depth - 1)}" if depth > 1 else _FLAT
    return rf"\((?:[^()<>'\"`]++|{QUOTED}|{inner})*+\)"


def _angles(depth: int) -> str:
    """A type's balanced ``<`` and ``>``."""
    inner = f"|{_angles(depth - 1)}" if depth > 1 else ""
    return rf"<(?:[^<>()'\"`]++|{QUOTED}|{_FLAT}{inner})*+>"


def _token(*more: str) -> str:
    """All up to the next comma or bracket, with brackets that hold no others, and what else is read as a whole."""
    whole = "|".join([rf"[^(),<>'\"`]++|{QUOTED}|{_FLAT}|(?<={_TYPE_WORD})<[^<>()'\"`]*+>", *more])
    return rf"(?:{whole})++|[(),<>'\"`]"


_TOKEN = _token(_round(_NATIVE), rf"(?<=\b{_TYPE_WORD}){_angles(_NATIVE)}")
_STATE = "struct<depth: int, angles: int, now: string, fields: array<string>>"


def _columns_and_rest(column_list: Column, token: str = _TOKEN) -> Column:
    """Read what follows a table's first ``(`` into ``fields`` and what follows the list (``now``).

    Commas part fields only outside brackets, so ``decimal(13, 2)`` and
    ``struct<a: int, b: map<string, int>>`` stay whole, however deep they nest. ``depth`` is 0 once
    the list is closed.
    """
    nothing, zero, one = F.lit(""), F.lit(0), F.lit(1)
    no_fields = F.array().cast("array<string>")

    def state(depth: Column, angles: Column, now: Column, fields: Column) -> Column:
        return F.struct(
            depth.alias("depth"), angles.alias("angles"), now.alias("now"), fields.alias("fields")
        )

    def read(seen: Column, token: Column) -> Column:
        depth, angles, now, fields = (
            seen[name] for name in ("depth", "angles", "now", "fields")
        )
        more = F.concat(now, token)
        in_list = (depth == one) & (angles == zero)
        opens_type = (token == F.lit("<")) & ((angles > zero) | now.rlike(_NESTED_TYPE))
        closes_type = (token == F.lit(">")) & (angles > zero)
        return (
            F.when(
                (depth == zero) | (F.length(token) > one), state(depth, angles, more, fields)
            )
            .when(
                (token == F.lit(",")) & in_list,
                state(depth, angles, nothing, F.array_append(fields, now)),
            )
            .when(
                (token == F.lit(")")) & (depth == one),
                state(zero, zero, nothing, F.array_append(fields, now)),
            )
            .when(token == F.lit("("), state(depth + one, angles, more, fields))
            .when(token == F.lit(")"), state(depth - one, angles, more, fields))
            .when(opens_type, state(depth, angles + one, more, fields))
            .when(closes_type, state(depth, angles - one, more, fields))
            .otherwise(state(depth, angles, more, fields))
        )

    tokens = F.regexp_extract_all(column_list, F.lit(token), F.lit(0))
    return F.aggregate(tokens, state(one, zero, nothing, no_fields).cast(_STATE), read)


def _unquoted_comment(text: Column, fold_case: bool, pattern: str = _COMMENT) -> Column:
    """The text of a ``COMMENT '...'`` clause, or the empty string."""
    literal = F.regexp_extract(text, pattern, 1)
    inner = F.substring(literal, F.lit(2), F.greatest(F.length(literal) - F.lit(2), F.lit(0)))
    comment = strip(F.replace(inner, F.lit("''"), F.lit("'")))
    return F.lower(comment) if fold_case else comment


def ddl_dictionary(scripts: DataFrame, text: str = "text", fold_case: bool = False) -> DataFrame:
    """One row per column of each ``CREATE TABLE`` statement of each script.

    Adds ``pos`` (statement), ``field_pos`` and the columns named in ``HEADINGS`` to the script's
    other columns. Names and types are in lower case; ``fold_case`` also lowers comments. A
    statement without a column list, such as ``CREATE TABLE ... AS SELECT``, has no rows. A key
    clause inside the list comes out as a column named by its first word. Columns that
    ``PARTITIONED BY`` declares with a type follow those of the list.
    """
    others = [name for name in scripts.columns if name != text]
    after_head = F.length("head") + F.lit(2)
    parts = each(
        marked(scripts, text), others, script_text.statements(F.col(text)), "part"
    )
    tables = (
        parts.where(F.col("part.code").rlike(_CREATE_TABLE))
        .select(*others, "pos", collapse_spaces(F.col("part.code")).alias("code"))
        .select(*others, "pos", "code", F.regexp_extract("code", _HEAD, 0).alias("head"))
        .select(
            *others,
            "pos",
            "head",
            _columns_and_rest(F.substring("code", after_head, F.length("code"))).alias("body"),
        )
    )
    head = F.col("head")
    after_name = strip(F.regexp_replace(F.regexp_replace(head, _TABLE_NAME, ""), _COMMENT, ""))
    options = F.concat_ws(" ", head, F.col("body.now"))
    inner = F.regexp_extract("body.now", _PARTITIONED, 1)
    partitions = _columns_and_rest(F.substring(inner, F.lit(2), F.length(inner)))["fields"]
    declared = F.filter(
        F.transform(partitions, strip), lambda field: field.rlike(rf"^{_NAME} (?!comment\b)[^ ]")
    )
    named = F.lower("body.now").contains("partitioned by")
    typed = F.when(named, declared).otherwise(F.array().cast("array<string>"))
    fields = F.filter(F.transform("body.fields", strip), lambda field: field != F.lit(""))
    # Not as a filter: Spark would move it below, and read every statement twice.
    complete = (F.col("body.depth") == F.lit(0)) & (after_name == F.lit(""))
    closed = tables.select(
        *others,
        F.col("pos").alias("stmt_pos"),
        F.lower(F.regexp_extract(head, _TABLE_NAME, 1)).alias("table_name"),
        _unquoted_comment(options, fold_case, _TABLE_COMMENT).alias("table_comment"),
        F.when(complete, F.concat(fields, typed)).alias("fields"),
    )
    columns = each(
        closed, [*others, "stmt_pos", "table_name", "table_comment"], F.col("fields"), "field"
    )
    field = F.col("field")
    tight = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(field, _COMMENT, ""), r" ?([(<,:]) ?", "$1"),
        r" ([)>])",
        "$1",
    )
    name_and_type = rf"^({_NAME})(?: ([^ ]++))?"
    return columns.select(
        *others,
        F.col("stmt_pos").alias("pos"),
        F.col("pos").alias("field_pos"),
        "table_name",
        "table_comment",
        F.lower(F.regexp_extract(tight, name_and_type, 1)).alias("field_name"),
        _unquoted_comment(field, fold_case).alias("field_comment"),
        F.lower(F.regexp_extract(tight, name_and_type, 2)).alias("field_type"),
    )


def dictionary_file(dictionary: DataFrame) -> DataFrame:
    """The dictionary's columns under the headings of its CSV file."""
    return dictionary.select(*[F.col(name).alias(shown) for name, shown in HEADINGS.items()])
