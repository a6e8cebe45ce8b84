"""Reading SQL script text: statements, comments, variables, templates and statement kinds.

Splitting and comment removal know string literals, quoted names, line comments and nested block
comments, by Spark's own expressions. The patterns read comments nested up to ``NATIVE_DEPTH``
levels; in the rare texts that may nest deeper, a depth that is folded over their tokens first marks
the inner ends of comments, and the marks are turned back at the end. Every repetition is possessive,
so a long text takes linear time and no deep stack.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodewright.functions.text import SPACE, collapse_spaces, lines, strip

NATIVE_DEPTH = 12

# A literal may hold backslash escapes; a doubled quote reads as two literals side by side.
SINGLE_QUOTED = r"'(?:[^'\\]++|\\[\s\S])*+'"
DOUBLE_QUOTED = r'"(?:[^"\\]++|\\[\s\S])*+"'
BACK_QUOTED = r"`[^`]*+`"
QUOTED = f"{SINGLE_QUOTED}|{DOUBLE_QUOTED}|{BACK_QUOTED}"

_LINE_COMMENT = r"--[^\r\n]*+"
_OPEN_TO_THE_END = r"['\"`][\s\S]*+|/\*[\s\S]*+"
_LINE_START = r"(?<![^\r\n])[ \t]*+"
_LINE_END = r"[ \t]*+(?![^\r\n])"

def _block_comment(depth: int) -> str:
    inner = f"|{_block_comment(depth - 1)}" if depth > 1 else ""
    return rf"/\*(?:[^*/]++|\*(?!/)|/(?!\*){inner})*+\*/"


_BLOCK = _block_comment(NATIVE_DEPTH)
_SINGLE = r"-(?!-)|/(?!\*)"
_IN_LINE = rf"[^-'\"`/\r\n]++|{QUOTED}|{_SINGLE}"
_OPEN = f"(?<open>{_OPEN_TO_THE_END})"

_STATEMENT = rf"(?:[^;'\"`/-]++|{QUOTED}|{_LINE_COMMENT}|{_BLOCK}|{_OPEN_TO_THE_END}|[/-])++"
_MALFORMED = (
    rf"\A(?:[^-'\"`/*]++|{QUOTED}|{_LINE_COMMENT}|{_BLOCK}|{_SINGLE}|\*(?!/))*+['\"`*/]"
)
# The next three name what stays in the text ``keep`` and ``open``; their other matches go. They
# match ordinary text in long runs, which is much faster than trying each character.
_COMMENT_LINES = (
    rf"{_LINE_START}{_LINE_COMMENT}"
    rf"|(?<keep>[\r\n]++|(?:{_IN_LINE}|{_BLOCK}|{_LINE_COMMENT})++)|{_OPEN}"
)
_WHOLE_LINE_COMMENTS = (
    rf"{_LINE_COMMENT}|{_LINE_START}(?!/\*\+){_BLOCK}{_LINE_END}"
    rf"|(?<keep>[\r\n]++|(?:{_IN_LINE}|{_BLOCK})++)|{_OPEN}"
)
_COMMENTS = (
    rf"(?<keep>(?:[^-'\"`/]++|{QUOTED}|{_SINGLE}|(?=/\*\+){_BLOCK})++)"
    rf"|{_LINE_COMMENT}|{_BLOCK}|{_OPEN}"
)
# Up to a block comment that alone parts two words, or else to the end.
_TOUCHING = (
    rf"(?:[^-'\"`/]++|{QUOTED}|{_LINE_COMMENT}|{_SINGLE}|(?=/\*\+){_BLOCK}|(?<!\S){_BLOCK}|{_BLOCK}(?!\S))*+"
    rf"(?:{_BLOCK}|[\s\S]*+)"
)
# Up to a comment that nests too deep for the native patterns, or that never ends.
_UNREADABLE = rf"\A(?:[^-'\"`/]++|{QUOTED}|{_LINE_COMMENT}|{_SINGLE}|{_BLOCK})*+/\*"

# Stands before ``a`` for an inner ``/*``, before ``b`` for an inner ``*/``, and before ``c`` for
# the character itself.
_MARK = "\ue000"


# What a mark may depend on; all else comes in runs.
_TOKEN = r"[/*'\"`\\\r\n-]|[^/*'\"`\\\r\n-]++"
# Tokens that are read into one string, before it is put aside: strings grow in small steps only.
_TOKEN_BLOCK = rf"(?:{_TOKEN}){{1,64}}+"
# What the reader of tokens is in: code, a comment (its depth), or one of these.
_IN_SINGLE, _IN_DOUBLE, _IN_BACK, _IN_LINE_COMMENT = -1, -2, -3, -4


def _next(state: Column, token: Column) -> Column:
    """The state ``(depth, held, out)`` behind a token. ``held`` is a character that may be half of a mark."""
    depth, held = state["depth"], state["held"]
    code, block = depth == 0, depth > 0
    opens = (code | block) & (held == F.lit("/")) & (token == F.lit("*"))
    closes = block & (held == F.lit("*")) & (token == F.lit("/"))
    to_line = code & (held == F.lit("-")) & (token == F.lit("-"))
    escapes = depth.isin(_IN_SINGLE, _IN_DOUBLE) & (held == F.lit("\\"))
    ends = (
        ((depth == _IN_SINGLE) & (token == F.lit("'")))
        | ((depth == _IN_DOUBLE) & (token == F.lit('"')))
        | ((depth == _IN_BACK) & (token == F.lit("`")))
    )
    after = (
        F.when(opens, depth + 1)
        .when(closes, depth - 1)
        .when(to_line, F.lit(_IN_LINE_COMMENT))
        .when(code & (token == F.lit("'")), F.lit(_IN_SINGLE))
        .when(code & (token == F.lit('"')), F.lit(_IN_DOUBLE))
        .when(code & (token == F.lit("`")), F.lit(_IN_BACK))
        .when(ends & ~escapes, F.lit(0))
        .when((depth == _IN_LINE_COMMENT) & token.isin("\r", "\n"), F.lit(0))
        .otherwise(depth)
    )
    whole = opens | closes | to_line | escapes
    waits = ~whole & (
        (code & token.isin("/", "-"))
        | (block & token.isin("/", "*"))
        | (depth.isin(_IN_SINGLE, _IN_DOUBLE) & (token == F.lit("\\")))
    )
    read = (
        F.when(opens & block, F.lit(_MARK + "a"))
        .when(closes & (depth > 1), F.lit(_MARK + "b"))
        .when(waits, held)
        .otherwise(F.concat(held, token))
    )
    return F.struct(
        after.cast("int").alias("depth"),
        F.when(waits, token).otherwise(F.lit("")).alias("held"),
        F.concat(state["out"], read).alias("out"),
    )


def _with_marked_comments(text: Column) -> Column:
    """The text with its inner comment ends marked, however deep: a depth folded over its tokens, block by block."""
    blocks = F.regexp_extract_all(F.replace(text, F.lit(_MARK), F.lit(_MARK + "c")), F.lit(_TOKEN_BLOCK), F.lit(0))
    none = F.array().cast("array<string>")

    def read_block(so_far: Column, block: Column) -> Column:
        begin = F.struct(so_far["depth"].alias("depth"), so_far["held"].alias("held"), F.lit("").alias("out"))
        read = F.aggregate(F.regexp_extract_all(block, F.lit(_TOKEN), F.lit(0)), begin, _next)
        return F.struct(
            read["depth"].alias("depth"),
            read["held"].alias("held"),
            F.array_append(so_far["outs"], read["out"]).alias("outs"),
        )

    begin = F.struct(F.lit(0).alias("depth"), F.lit("").alias("held"), none.alias("outs"))
    return F.aggregate(blocks, begin, read_block, lambda end: F.concat(F.array_join(end["outs"], ""), end["held"]))


def marked(text: Column) -> Column:
    """The text of a script with its comments marked so that the functions below can read it."""
    unreadable = text.contains("/*") & text.rlike(_UNREADABLE)
    plain = F.replace(text, F.lit(_MARK), F.lit(_MARK + "c"))
    return F.when(unreadable, _with_marked_comments(text)).otherwise(plain)


def _unmarked(text: Column) -> Column:
    for letter, original in (("a", "/*"), ("b", "*/"), ("c", _MARK)):
        text = F.replace(text, F.lit(_MARK + letter), F.lit(original))
    return text


def _code(stmt: Column) -> Column:
    """A trimmed statement without its comments."""
    parted = F.regexp_replace(stmt, _TOUCHING, "$0 ")
    code = strip(F.regexp_replace(parted, _COMMENTS, "${keep}${open}"))
    return F.when(stmt.contains("--") | stmt.contains("/*"), code).otherwise(stmt)


def statements(script: Column) -> Column:
    """The statements of a marked script: an array of ``(stmt, code)`` in script order.

    ``;`` separates statements unless it is inside a literal, a quoted name or a comment, and the
    last statement needs none. ``stmt`` is trimmed and keeps its comments, except those that fill
    a line after ``--``; ``code`` has no comments but hints. Statements without code are left out.
    """
    no_lines = F.regexp_replace(script, _COMMENT_LINES, "${keep}${open}")
    shorter = F.when(script.contains("--"), no_lines).otherwise(script)
    parts = F.regexp_extract_all(shorter, F.lit(_STATEMENT), F.lit(0))
    rows = F.transform(
        F.transform(parts, strip),
        lambda stmt: F.struct(
            _unmarked(stmt).alias("stmt"), _unmarked(_code(stmt)).alias("code")
        ),
    )
    return F.filter(rows, lambda row: row["code"] != F.lit(""))


def malformed(script: Column) -> Column:
    """Whether a literal or comment in a marked script never ends, or one ends unopened."""
    return script.rlike(_MALFORMED)


def without_comments(script: Column) -> Column:
    """A marked script without ``--`` comments and block comments that fill whole lines.

    Other comments, hints (``/*+ ... */``) and text inside literals stay. No marks remain.
    """
    stripped = F.regexp_replace(script, _WHOLE_LINE_COMMENTS, "${keep}${open}")
    return _unmarked(strip(stripped))


# A separator is a semicolon before the end, a line end or a line comment.
_LINE_SEPARATOR = rf"(?U);{SPACE}*$|;(?={SPACE}*\n)|;(?={SPACE}*--)"


def statements_at_line_ends(text: Column) -> Column:
    """Split at semicolons that end a line, whatever quotes say; trimmed, without blank parts."""
    parts = F.transform(F.split(text, _LINE_SEPARATOR, -1), strip)
    return F.filter(parts, lambda part: part != F.lit(""))


# Fixed value: a variable line, after its white space was collapsed.
_VARIABLE = r"(?i)^set var: ?([^=;]*[^=; ]) ?= ?([^;]*?) ?(?:;.*)?$"


def variables(text: Column) -> Column:
    """The ``set var: k = v;`` lines of a script: an array of ``(k, v)`` in script order.

    Upper or lower case; ``k`` ends at the first ``=`` and ``v`` at the first ``;``.
    """
    found = F.filter(
        F.transform(lines(text), collapse_spaces), lambda line: line.rlike(_VARIABLE)
    )
    pairs = F.transform(
        found,
        lambda line: F.struct(
            F.regexp_extract(line, _VARIABLE, 1).alias("k"),
            F.regexp_extract(line, _VARIABLE, 2).alias("v"),
        ),
    )
    none = F.array().cast("array<struct<k: string, v: string>>")
    return F.when(text.rlike(rf"(?iU)set{SPACE}+var:"), pairs).otherwise(none)


def rendered(text: Column, script_variables: Column, external: Mapping[str, str]) -> Column:
    """Replace ``${k}``: the script's own variables in order, then ``external`` ones.

    One after the other, so a value may name a later variable. Unknown ``${x}`` stay.
    """

    def put(so_far: Column, variable: Column) -> Column:
        name = F.concat(F.lit("${"), variable["k"], F.lit("}"))
        return F.replace(so_far, name, variable["v"])

    result = F.aggregate(script_variables, text, put)
    for key, value in external.items():
        result = F.replace(result, F.lit("${" + key + "}"), F.lit(value))
    return result


_LEAD = r"(?i)^(?:set\s+var:|add\s+jar\b|[a-z]++)"
_SET = r"(?is)^set\s+([^=]*?)\s*=\s*(.*)\z"
_ADD_JAR = r"(?is)^add\s+jar\s+(.*)\z"
_INSERT = r"(?is)^(?:with|from)\b.*\binsert\s+(?:into|overwrite)\b"


def leading_words(code: Column) -> Column:
    """The words in lower case that tell a statement's kind; the statement has no comments."""
    return F.lower(F.regexp_extract(code, _LEAD, 0))


def sets_variable(lead: Column) -> Column:
    """Whether a statement that starts with ``lead`` is a ``set var:`` line."""
    return lead.endswith(":")


def statement_kind(code: Column, lead: Column) -> Column:
    """``set_variable``, ``set``, ``add_jar``, ``insert`` or ``other``.

    The leading words decide, also for an ``INSERT`` after ``WITH`` or ``FROM``; words inside
    literals do not count.
    """
    inserts = F.regexp_replace(code, QUOTED, "''").rlike(_INSERT)
    return (
        F.when(sets_variable(lead), F.lit("set_variable"))
        .when(lead == F.lit("set"), F.lit("set"))
        .when(lead.rlike(r"^add\s+jar$"), F.lit("add_jar"))
        .when(lead == F.lit("insert"), F.lit("insert"))
        .when(lead.isin("with", "from") & inserts, F.lit("insert"))
        .otherwise(F.lit("other"))
    )


def statement_key_and_value(code: Column, kind: Column) -> tuple[Column, Column]:
    """Key and value of a variable or setting; for ``add_jar`` the path as value."""

    def unquoted(pattern: str, group: int) -> Column:
        text = strip(F.regexp_extract(code, pattern, group))
        return strip(F.regexp_replace(text, r"(?s)^(['\"])(.*)\1$", "$2"))

    one_line = collapse_spaces(code)
    is_variable, is_jar = kind == F.lit("set_variable"), kind == F.lit("add_jar")
    assigns = (kind == F.lit("set")) & code.contains("=")
    key = F.when(is_variable, F.regexp_extract(one_line, _VARIABLE, 1)).when(
        assigns, unquoted(_SET, 1)
    )
    value = (
        F.when(is_variable, F.regexp_extract(one_line, _VARIABLE, 2))
        .when(assigns, unquoted(_SET, 2))
        .when(is_jar, unquoted(_ADD_JAR, 1))
    )
    return key, value


_WRAPPER = r"\bexecute\s++statement\s++set\s++begin\b"
_GAP = rf"(?:\s++|{_LINE_COMMENT}|{_BLOCK})*+"
_CODE = rf"{QUOTED}|{_LINE_COMMENT}|{_BLOCK}"
_STATEMENT_SET = (
    rf"(?i)(?<head>(?:[^-'\"`/e]++|{_CODE}|(?!{_WRAPPER})[-/e])*+)"
    rf"(?:{_WRAPPER}(?<body>(?:[^-'\"`/;]++|{_CODE}|[-/]|;(?!{_GAP}end{_GAP};))*+;{_GAP})end{_GAP};"
    r"|(?<rest>[\s\S]*+))"
)


def without_statement_set(text: Column) -> Column:
    """Remove ``EXECUTE STATEMENT SET BEGIN`` and the ``END;`` that closes it from a marked script.

    The closing ``END`` follows a semicolon, so the one of a ``CASE ... END;`` stays. Words inside
    literals and comments are neither; comments between the last statement and ``END`` stay.
    """
    parts = F.regexp_replace(text, _STATEMENT_SET, "${head}${body}${rest}")
    return _unmarked(F.when(text.rlike(rf"(?i){_WRAPPER}"), parts).otherwise(text))
