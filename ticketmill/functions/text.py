"""Text helpers whose meaning must be the same in every engine we compare with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Maximal run of letters, numbers and underscore. Java's ``\w`` is ASCII, so
# the class is always spelled out; ``python_pattern`` maps it to Python's ``\w``.
WORD_CHAR = r"[\p{L}\p{N}_]"
WORD_RUN = WORD_CHAR + "+"
WORD_START = rf"(?<!{WORD_CHAR})"
WORD_END = rf"(?!{WORD_CHAR})"

# The characters Python's ``str.strip`` removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def python_pattern(java_pattern: str) -> str:
    """The same pattern for Python's ``re``."""
    return java_pattern.replace(WORD_CHAR, r"\w").replace(r"\p{Nd}", r"\d")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_RUN))
