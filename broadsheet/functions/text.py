"""Text helpers that agree with Python's notion of whitespace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.isspace() accepts.  Spark's plain
# trim() removes spaces only.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# The same set inside a Java character class.
WS_CLASS = r"\t-\r\x1c- \x85\xa0  -     　"
WS = f"[{WS_CLASS}]"

# No letter, digit or underscore follows / precedes, in any script.
WORD_END = r"(?![\p{L}\p{N}_])"
WORD_START = r"(?<![\p{L}\p{N}_])"


def strip(text: Column) -> Column:
    """Remove surrounding whitespace of any kind."""
    return F.trim(text, F.lit(_SPACES))


def strip_sql(name: str) -> str:
    """:func:`strip` as SQL text."""
    return f"trim(BOTH '{_SPACES}' FROM {name})"


def squeeze_sql(name: str) -> str:
    """SQL that turns each inner run of whitespace of a stripped text into one
    space."""
    return f"CASE WHEN {name} RLIKE r'[^ -~]|  ' THEN regexp_replace({name}, r'{WS}+', ' ') ELSE {name} END"
