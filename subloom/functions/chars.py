"""Character classes, written so that Java's and RE2's regular expressions read them alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, as Unicode text processing has it (fixed values).
SPACE = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Letters: also letter and other numbers, as a word character that is neither digit nor underscore.
LETTER = r"[\p{L}\p{Nl}\p{No}]"
LATIN = r"[A-Za-z\x{c0}-\x{24f}]"
CYRILLIC = r"[\x{400}-\x{4ff}]"
WORD = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}'\x{2019}\-]*"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """White space removed from both ends."""
    return F.regexp_replace(col(c), rf"^[{SPACE}]+|[{SPACE}]+$", "")


def one_line(c: str | Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(col(c), rf"[{SPACE}]+", " "), "^ | $", "")


def count(c: str | Column, pattern: str) -> Column:
    return F.regexp_count(col(c), F.lit(pattern))
