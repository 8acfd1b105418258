"""Text cleaners (C1 to C11): string columns to string columns. Null stays null."""

from __future__ import annotations

import textwrap
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loamworks.functions.text import SPACE, blank, newline_parts, strip

# Signs of code, any of which makes a bracketed line no header.
CODE_SIGNS = ("=", "(", ")", "{", "}", ";", "function", "const", "let", "var", "class", "import", "export")
MASKED_KEY = "-----BEGIN PRIVATE KEY-----\n<MASKED_PRIVATE_KEY>\n-----END PRIVATE KEY-----"


def mask_private_key(text: Column) -> Column:
    return F.regexp_replace(text, r"(?is)-----BEGIN (?:RSA )?PRIVATE KEY-----.*?-----END (?:RSA )?PRIVATE KEY-----", MASKED_KEY)


def drop_leading_blank_lines(text: Column) -> Column:
    return F.when(blank(text), F.lit("")).otherwise(F.regexp_replace(text, r"\A(?:[^\S\n]*\n)+", ""))


def drop_tag_header(text: Column) -> Column:
    """Cut after the last line with angle brackets and no sign of code before the first line of any other kind."""
    lines = newline_parts(text)

    def kind(line: Column) -> Column:
        signs = F.lit(False)
        for sign in CODE_SIGNS:
            signs = signs | line.contains(sign)
        header = line.contains("<") & line.contains(">") & ~signs & ~strip(line).startswith("//")
        return F.when(blank(line), 0).when(header, 1).otherwise(2)

    kinds = F.transform(lines, kind)
    stop = F.array_position(kinds, 2)
    head = F.when(stop > 0, F.slice(kinds, F.lit(1), (stop - 1).cast("int"))).otherwise(kinds)
    from_end = F.array_position(F.reverse(head), 1)
    start = F.when(from_end > 0, F.size(head) - from_end + 1).otherwise(0).cast("int")
    return F.array_join(F.slice(lines, start + 1, F.size(lines)), "\n")


def drop_licence_comments(text: Column, strict: bool = False) -> Column:
    """Remove block comments about copyright. As written elsewhere, the match may start at an earlier comment and take
    the code between; with ``strict`` it stays within one comment."""
    inner = r"(?:(?!\*/).)*?" if strict else ".*?"
    return F.regexp_replace(F.regexp_replace(text, rf"(?is)/\*+{inner}(?:Copyright|Licensed){inner}\*/\s*", ""), rf"\A{SPACE}+", "")


def ensure_header(text: Column, path: Column, extensions: tuple[str, ...] = ("ets",)) -> Column:
    """Prepend ``// name`` from the path's last segment unless the first line that isn't blank is such a header."""
    has = text.rlike(rf"(?i)\A\s*//[^\S\n]*[^\n]+\.(?:{'|'.join(extensions)})[^\S\n]*(?:\n|\z)")
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    return F.when(has | path.isNull() | (F.size(parts) == 0), text).otherwise(F.concat(F.lit("// "), F.element_at(parts, -1), F.lit("\n"), text))


def drop_line_comments(text: Column) -> Column:
    return F.regexp_replace(text, r"//[^\n]*", "")


def unescaped(text: Column, quote: str = '\\\\"') -> Column:
    """For parsing only: doubled-backslash escapes become what they name, other escapes lose the backslash, one kind of
    line end. ``quote`` is the literal that stands for a double quote."""
    out = F.coalesce(text, F.lit(""))
    for escape, plain in (("\\\\n", "\n"), ("\\\\t", "\t"), ("\\\\r", "\r"), (quote, '"'), ("\\\\'", "'"), ("\\\\\\\\", "\\")):
        out = F.replace(out, F.lit(escape), F.lit(plain))
    return F.regexp_replace(F.regexp_replace(out, r"\\(.)", "$1"), r"\r\n?", "\n")


def unescaped_and_stripped(text: Column) -> Column:
    return strip(unescaped(text, '\\\\"'))


def leak_key(text: Column) -> Column:
    return F.translate(F.lower(text), "-_", "")


def markdown_text(text: Column) -> Column:
    """Links become their text, then images go; so an image with a description keeps ``!description``."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"\[([^\]]+)\]\([^)]+\)", "$1"), r"!\[[^\]]*\]\([^)]+\)", ""))


@F.pandas_udf(StringType())
def dedented(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: None if t is None else textwrap.dedent(t).strip())


def clean_code(text: Column, path: Column, extensions: tuple[str, ...] = ("ets",)) -> Column:
    """The cleaners in their fixed order."""
    t = drop_leading_blank_lines(mask_private_key(text))
    t = drop_licence_comments(drop_tag_header(t))
    return ensure_header(drop_leading_blank_lines(t), path, extensions)
