"""Syntax checks (F5, F6, F17, F19) by a provider: any callable from text to counts.

The provider at hand is a lexer for strings, comments, template literals and brackets. Its counts are its own and not
those of a full parser; a parser is plugged in by passing another provider.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT = "errors int, missing int, nodes int, functions int, empty_functions int"
_TOKEN = re.compile(r"//[^\n]*|/\*.*?\*/|/\*.*|\"(?:\\.|[^\"\\\n])*\"?|'(?:\\.|[^'\\\n])*'?|`(?:\\.|[^`\\])*`?|[A-Za-z_$][\w$]*|\d[\w.]*|\s+|.", re.DOTALL)
_CLOSES = {")": "(", "]": "[", "}": "{"}


def lex(text: str | None) -> tuple[int, int, int, int, int]:
    """(brackets closed wrongly and strings left open, brackets never closed, tokens, functions, functions with nothing in them)"""
    stack: list[tuple[str, int]] = []
    errors = functions = empty = 0
    solid = [t for t in _TOKEN.findall(text or "") if not t.isspace() and not t.startswith(("//", "/*"))]
    for at, t in enumerate(solid):
        if t[0] in "\"'`" and (len(t) < 2 or t[-1] != t[0]):
            errors += 1
        elif t in "([{":
            body = t == "{" and at > 0 and (solid[at - 1] == ")" or solid[at - 1 : at] == [">"] and at > 1 and solid[at - 2] == "=")
            functions += body
            stack.append((t, at if body else -1))
        elif t in _CLOSES:
            if stack and stack[-1][0] == _CLOSES[t]:
                empty += stack.pop()[1] == at - 1
            else:
                errors += 1
    return errors, len(stack), len(solid), functions, empty


def checked(provider: Callable[[str], tuple] = lex) -> Callable[[Column], Column]:
    @F.pandas_udf(REPORT)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.DataFrame([provider(t) for t in s], columns=["errors", "missing", "nodes", "functions", "empty_functions"])

    return run


def syntax_ok(report: Column, errors: int = 0) -> Column:
    return (report["missing"] == 0) & (report["errors"] <= errors)


def few_empty_functions(report: Column, most: int = 5, share: float = 0.3) -> Column:
    n = report["empty_functions"]
    return (report["functions"] == 0) | ((n <= most) & (n <= F.lit(share) * report["functions"]))


def with_syntax_reason(df: DataFrame, text: Column, provider: Callable[[str], tuple] = lex) -> DataFrame:
    """Second phase of the filter chain: only rows without a reason yet reach the parser."""
    ok = df.where("reject_reason is null").withColumn("__s", checked(provider)(text))
    reason = F.when(~syntax_ok(F.col("__s")), "syntax").when(~few_empty_functions(F.col("__s")), "empty_function_density")
    return df.where("reject_reason is not null").unionByName(ok.withColumn("reject_reason", reason).drop("__s"))


def triage(df: DataFrame, text: Column, provider: Callable[[str], tuple] = lex) -> DataFrame:
    """``syntax``: valid (up to three errors, no bracket missing), minor (up to ten of both) or major (more, or no text)."""
    s = F.col("__s")
    kind = F.when(F.coalesce(text, F.lit("")) == "", "major").when((s["errors"] <= 3) & (s["missing"] == 0), "valid").when(s["errors"] + s["missing"] <= 10, "minor").otherwise("major")
    return df.withColumn("__s", checked(provider)(text)).withColumn("syntax", kind).drop("__s")
