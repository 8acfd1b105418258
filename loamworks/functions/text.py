"""Column builders for text: lines, white space, counts. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line boundaries, and white space beyond Java's \s.
LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def newline_parts(text: Column) -> Column:
    """Cut at every line feed; empty parts stay."""
    return F.split(text, "\n", -1)


def text_lines(text: Column) -> Column:
    """Lines at any boundary; a closing boundary makes no further line and an empty text has none."""
    parts = F.split(F.regexp_replace(text, rf"(?:{LINE_BREAK})\z", ""), LINE_BREAK, -1)
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(parts)


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def blank(c: Column) -> Column:
    return strip(c) == ""


def count_of(text: Column, token: str) -> Column:
    """Occurrences of a literal, none overlapping."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(token)))) / len(token)).cast("long")


def preview(text: Column, chars: int = 200) -> Column:
    return F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("..."))).otherwise(text)
