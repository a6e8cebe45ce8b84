from __future__ import annotations

import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodewright.functions import script_text
from lodewright.operators import scripts
from lodewright.operators.dictionary import HEADINGS, ddl_dictionary, dictionary_file

# What may hide a separator, with a place for it.
HOLDERS = {
    "single": "'{}'", "double": '"{}"', "back": "`{}`", "block": "/* {} */", "nested": "/* /* {} */ */",
    "line": "-- {}\n",
}
# What would mean something in code; quotes of the holder's own kind and ends of comments are left out.
MARKS = {
    ";": (), "--": (), "/*": ("block", "nested"), "'": ("single",), '"': ("double",), "`": ("back",),
    "end;": (), "${x}": (), "set var: k = v;": (),
}
CASES = [
    (holder.format(mark), name)
    for mark, never in MARKS.items()
    for name, holder in HOLDERS.items()
    if name not in never
]


def _frame(spark, *texts):
    return spark.createDataFrame(
        [(number, text) for number, text in enumerate(texts)], "script_id int, text string"
    ).repartition(1)


def _split(spark, *texts):
    rows = scripts.split_statements(_frame(spark, *texts)).orderBy("script_id", "pos").collect()
    return [(row.script_id, row.pos, row.stmt, row.malformed) for row in rows]


def test_every_holder_hides_every_mark(spark):
    texts = [f"head {held} tail; next" for held, _ in CASES]
    found = {(row[0], row[1]): row[2:] for row in _split(spark, *texts)}
    for number, (held, name) in enumerate(CASES):
        kept = f"head {held} tail" if name != "line" else f"head {held} tail"
        assert found[number, 0] == (kept, False), held
        assert found[number, 1] == ("next", False), held
    assert len(found) == 2 * len(CASES)


def test_kinds_keys_and_numbers(spark):
    text = (
        "set var: n = 3;set 'k.a' = 'it''s'; set k.b = a \"q\" b;add jar '/x.jar';/* c */ insert into t select 1;"
        "from s insert overwrite t select 2;with w as (select 'insert into') select 3;;  ;select/*touching*/4"
    )
    rows = scripts.classify_statements(_frame(spark, text)).orderBy("pos").collect()
    assert [(row.kind, row.key, row.value, row.sql_id) for row in rows] == [
        ("set_variable", "n", "3", None),
        ("set", "k.a", "it''s", 1),
        ("set", "k.b", 'a "q" b', 2),
        ("add_jar", None, "/x.jar", 3),
        ("insert", None, None, 4),
        ("insert", None, None, 5),
        ("other", None, None, 6),
        ("other", None, None, 7),
    ]


def test_many_touching_comments_take_linear_time(spark):
    text = "a/*x*/+b/*y*/" * 80_000
    began = time.perf_counter()
    rows = scripts.classify_statements(_frame(spark, text)).collect()
    assert len(rows) == 1 and len(rows[0].stmt) == len(text)
    assert time.perf_counter() - began < 10


def _marked_plainly(text):
    """Inner comment ends marked, one character after the other."""
    out, at, depth, quote = "", 0, 0, ""
    while at < len(text):
        two = text[at : at + 2]
        if quote:
            step = 2 if quote in "'\"" and text[at] == "\\" else 1
            if (text[at] in "\r\n") if quote == "-" else (text[at] == quote):
                quote = ""
            out, at = out + text[at : at + step], at + step
        elif two == "/*":
            out, at, depth = out + ("\ue000a" if depth else two), at + 2, depth + 1
        elif two == "*/" and depth:
            out, at, depth = out + ("\ue000b" if depth > 1 else two), at + 2, depth - 1
        elif two == "--" and not depth:
            out, at, quote = out + two, at + 2, "-"
        else:
            if text[at] in "'\"`" and not depth:
                quote = text[at]
            out, at = out + text[at], at + 1
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["/*", "*/", "/", "*", "-", "'", '"', "`", "\\", "\n", "x y", ";"]), max_size=150)
                .map("".join), min_size=20, max_size=20))
def test_comments_are_marked_at_any_depth(spark, texts):
    texts = [*texts, "/*" * 200 + " ' " + "*/" * 200 + "'/*'", "/*" * 7 + "*/" * 9]
    frame = _frame(spark, *texts).select("text", script_text._with_marked_comments(F.col("text")).alias("marked"))
    for row in frame.collect():
        assert row.marked == _marked_plainly(row.text)


def test_deep_comments_take_linear_time(spark):
    text = "select 1;" + "/*" * 50_000 + ";" + "*/" * 50_000 + "; select '/*" * 2 + " x'/*a'*/" * 50_000
    began = time.perf_counter()
    rows = _split(spark, text)
    assert [row[2] for row in rows][0] == "select 1"
    assert time.perf_counter() - began < 20


def test_malformed_scripts_are_kept_and_marked(spark):
    assert _split(spark, "a; 'b; c", "/* a; /* b */ c", "a */ b", "", None, "a; b", '"') == [
        (0, 0, "a", True), (0, 1, "'b; c", True),
        (1, 0, "/* a; /* b */ c", True),
        (2, 0, "a */ b", True),
        (5, 0, "a", False), (5, 1, "b", False),
        (6, 0, '"', True),
    ]


def test_deep_comments_and_the_mark_itself(spark):
    deep = "/*" * 40 + "; it's" + "*/" * 40
    mark = ""
    assert _split(spark, f"select 1{deep};{mark}a{mark} {deep} b;c", f"{mark}a;{mark}{mark}b") == [
        (0, 0, f"select 1{deep}", False), (0, 1, f"{mark}a{mark} {deep} b", False),
        (0, 2, "c", False),
        (1, 0, f"{mark}a", False), (1, 1, f"{mark}{mark}b", False),
    ]
    stripped = scripts.strip_comments(_frame(spark, f"a -- x\n{deep}\n, {deep} '--'")).first().text
    assert stripped == f"a \n\n, {deep} '--'"


def test_long_text_needs_no_deep_stack(spark):
    long = "select '" + "x;''" * 50_000 + "' /* a /* b; */ c */ -- it's;\n; " + "'a'-" * 100_000
    assert [row[2][:9] for row in _split(spark, long)] == ["select 'x", "'a'-'a'-'"]


_word = st.text("ab;'\"`-/* \n\\x", max_size=8)
_comment = st.recursive(
    st.text("ab;'\"` \n", max_size=4), lambda inner: inner.map(lambda text: f"/*{text}*/"),
    max_leaves=8,
)
_piece = st.one_of(
    st.sampled_from(["select", "1", "+ b", "\n", "f(x)"]),
    _word.map(lambda text: "'" + text.replace("\\", "\\\\").replace("'", "''") + "'"),
    _word.map(lambda text: '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'),
    _word.map(lambda text: "`" + text.replace("`", "") + "`"),
    _comment.map(lambda text: f"/* {text} */"),
    st.text("ab;'\"`/*", max_size=6).map(lambda text: f"x -- {text}\n"),
)
_statement = st.lists(_piece, max_size=6).map(lambda pieces: " ".join(["q", *pieces, "z"]))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(_statement, min_size=1, max_size=6), min_size=20, max_size=40))
def test_split_gives_back_joined_statements(spark, groups):
    found = _split(spark, *[";".join(group) for group in groups])
    wanted = [
        (number, pos, stmt, False)
        for number, group in enumerate(groups)
        for pos, stmt in enumerate(group)
    ]
    assert found == wanted


def test_simple_split(spark):
    text = "select ';' as a;\n\n select 1; select 2 ; -- c;\nx;  \n ;\n last ;  "
    rows = scripts.split_statements_simple(_frame(spark, text)).orderBy("pos").collect()
    assert [row.stmt for row in rows] == [
        "select ';' as a", "select 1; select 2", "-- c", "x", "last"
    ]


def test_variables_and_templates(spark):
    text = (
        "set var: a  = b; -- note\n-- set var: off = 1;\nSET  VAR:c = ${d} =\t${a};\n"
        " set var: indented = 1;\nset var: nothing\nselect '${a}', '${c}', '${d}', '${x}', '${dt}'"
    )
    pairs = scripts.extract_variables(_frame(spark, text)).orderBy("pos").collect()
    assert [(row.k, row.v) for row in pairs] == [("a", "b"), ("c", "${d} = ${a}")]
    rendered = scripts.render_templates(_frame(spark, text), {"a": "no", "dt": "2023", "d": "D"})
    assert rendered.first().text.splitlines()[-1] == "select 'b', 'D = no', 'D', '${x}', '2023'"


def test_unwrap_statement_set(spark):
    text = (
        "select 'weekend;';\nEXECUTE   STATEMENT SET\n BEGIN\ninsert into a select case when 1 = 1 "
        "then 2 END;\ninsert into b select 3; -- last\nEND ;\nselect 1;"
    )
    assert scripts.unwrap_statement_set(_frame(spark, text)).first().text == (
        "select 'weekend;';\n\ninsert into a select case when 1 = 1 then 2 END;\n"
        "insert into b select 3; -- last\n\nselect 1;"
    )


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("EXECUTE STATEMENT SET BEGIN insert into a select '; end; x' ; insert into b select 1; END;",
         " insert into a select '; end; x' ; insert into b select 1; "),
        ("select 'execute statement set begin k; end;'", "select 'execute statement set begin k; end;'"),
        ("execute statement set begin x; /* done; end; */ END;", " x; /* done; end; */ "),
        ("a; execute statement set begin x;", "a; execute statement set begin x;"),
        ("execute statement set begin x; end; y; execute statement set begin z; end;", " x;  y;  z; "),
    ],
)
def test_unwrapping_reads_literals_and_comments(spark, text, wanted):
    assert scripts.unwrap_statement_set(_frame(spark, text)).first().text == wanted


DDL = """
CREATE TABLE IF NOT EXISTS Lib.books (isbn string, price decimal(9, 2) comment 'with, comma (and brackets)',
  pages int) comment 'Books';
create table lib.loans (who bigint comment 'it''s a reader', parts struct<a: int, b: map<string, array<int>>>)
  with ('comment' = 'x') partitioned by (day string comment 'day', hour int) comment 'Loans';
create table copied as select f(a, b), c from t;
create table unfinished (a int, b int;
create table lib.plain (n int) partitioned by (n)"""


def test_dictionary(spark):
    frame = ddl_dictionary(_frame(spark, DDL)).orderBy("pos", "field_pos")
    rows = [tuple(row[name] for name in HEADINGS) for row in frame.collect()]
    assert rows == [
        ("lib.books", "Books", "isbn", "", "string"),
        ("lib.books", "Books", "price", "with, comma (and brackets)", "decimal(9,2)"),
        ("lib.books", "Books", "pages", "", "int"),
        ("lib.loans", "Loans", "who", "it's a reader", "bigint"),
        ("lib.loans", "Loans", "parts", "", "struct<a:int,b:map<string,array<int>>>"),
        ("lib.loans", "Loans", "day", "day", "string"),
        ("lib.loans", "Loans", "hour", "", "int"),
        ("lib.plain", "", "n", "", "int"),
    ]
    folded = ddl_dictionary(_frame(spark, DDL), fold_case=True)
    assert "books" in {row.table_comment for row in folded.collect()}
    assert dictionary_file(folded).columns == ["表名", "表描述", "字段名", "字段描述", "字段类型"]


def test_column_lists_are_read_in_few_tokens_and_as_token_by_token(spark):
    import random

    from lodewright.operators.dictionary import _TOKEN, _columns_and_rest, _token

    nested = "id int, tags struct<a: int, b: array<map<string, int>>>, x f((1, 2), g('(', (3))) )"
    pick = random.Random(3)
    parts = ["a", " ", ",", "(", ")", "<", ">", "array", "map<", "struct<b:", "'(,'", "'", '"', "`,`", "x array <", ">,", "(1, 2)"]
    texts = [nested, *("".join(pick.choices(parts, k=pick.randrange(1, 25))) for _ in range(3000))]
    rows = spark.createDataFrame([(text,) for text in texts], "text string")
    text = F.col("text")
    tokens = F.size(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)))
    found = rows.select(
        "text", tokens, _columns_and_rest(text), _columns_and_rest(text, _token())
    ).collect()
    # Three fields with the two commas between them, and the list's end.
    assert found[0][1] == 6
    assert [row for row in found if row[2] != row[3]] == []


def test_white_space_collapses_to_one_blank(spark):
    from lodewright.functions.text import SPACES, collapse_spaces

    texts = ["a b", "  a \t b\n", "a　b \x1c", "", " ", *(f"a{c}b {c} d{c}" for c in SPACES), "a​b᠎"]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").select("text", collapse_spaces(F.col("text")))
    for text, one in rows.collect():
        assert one == "".join(c for i, c in enumerate("".join(" " if c in SPACES else c for c in text)) if c != " " or i == 0 or text[i - 1] not in SPACES)
