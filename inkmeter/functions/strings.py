"""Small string helpers shared by the column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and line ends, as regex class bodies
WHITE = r"\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# The same white space as characters
WHITE_CHARS = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())

# A slice length past any array's end (start + length must stay an int)
TO_END = 1 << 30


def text(column: Column | str) -> Column:
    """The column with null read as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def strip(value: Column, chars: str = WHITE_CHARS) -> Column:
    """Trim a set of characters from both ends; reads the ends only."""
    return F.trim(value, F.lit(chars))


def rstrip(value: Column, chars: str = WHITE_CHARS) -> Column:
    return F.rtrim(value, F.lit(chars))


def is_blank(value: Column) -> Column:
    return ~value.rlike(rf"[^{WHITE}]")


def lines(block: Column) -> Column:
    """Non-blank lines of a block, untrimmed."""
    return F.filter(F.split(block, LINE_END), lambda line: ~is_blank(line))


def count_matches(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern))


def matches_all(value: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(value, F.lit(pattern), F.lit(group))


def let(value: Column, use) -> Column:  # noqa: ANN001
    """``use(value)`` with the value computed once however often it is read."""
    return F.get(F.transform(F.array(value), use), 0)
