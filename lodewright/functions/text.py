"""String helpers whose results follow Python and DuckDB where those differ from Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space of Python's ``str.isspace``. Java's plain \\s is ASCII only.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same as a class, for patterns that start with ``(?U)``: Java's Unicode white space leaves
# the four separators.
SPACE = r"[\s\x1c-\x1f]"
# The same without ``(?U)``, which asks for each character's properties. Printable ASCII, most of any text, is ruled
# out first. Of a lone blank nothing has to be collapsed.
_WIDE = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ANY_SPACE = rf"[[^!-~]&&[\t-\r\x1c-\x20{_WIDE}]]"
_UNEVEN = rf"(?: (?={ANY_SPACE})|[[^ -~]&&[\t-\r\x1c-\x1f{_WIDE}]]){ANY_SPACE}*+"


def xtrim(text: Column | str, numeric: bool = False) -> Column:
    """Drop all white space. NULL, the empty string and (``numeric``) zero give NULL.

    Text of nothing but white space gives the empty string, not NULL.
    """
    column = F.col(text) if isinstance(text, str) else text
    if numeric:
        column = F.nullif(column, F.lit(0))
    return F.regexp_replace(F.nullif(column.cast("string"), F.lit("")), f"(?U){SPACE}", "")


def strip(text: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def collapse_spaces(text: Column) -> Column:
    """Turn each run of white space into one blank."""
    return F.regexp_replace(text, _UNEVEN, " ")


def prefix(text: Column | str, length: int) -> Column:
    """The first ``length`` characters.

    DuckDB's ``substring(s, 0, n)`` counts from a position before the text, so it yields
    ``n - 1`` characters; Spark's yields ``n``. Naming the length avoids the difference.
    """
    return F.substring(text, 1, length)


def lines(text: Column) -> Column:
    """Split at every line boundary that Python's ``splitlines`` knows."""
    return F.split(text, r"\r\n|[\n-\r\x1c-\x1e\x85\u2028\u2029]", -1)


def padded(number: Column | str, width: int) -> Column:
    """A number's digits with zeros in front up to ``width``; longer ones are never cut."""
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))
