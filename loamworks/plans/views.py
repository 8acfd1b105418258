"""The corpora that the registered queries run on, as Spark tables and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LICENCE = "/* Copyright 2024 Example Authors */\n\n"
KEY = "-----BEGIN RSA PRIVATE KEY-----\nMIIabc\n-----END RSA PRIVATE KEY-----\n"
HEADER = "<repo>sample\n\n<file>a.ets\n\n"
REPEATED = "".join(f"static readonly entry_{c} = text;\n" for c in "abcdefgh")
NUMBERS = "const table = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12];\n\n\n"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
GENERATED = "// AUTO-GENERATED by a tool, do not edit\n"
BLANKS = "let first = 1\n" + " \n" * 400
COLONS = "".join(f"key_{i}: value of {c}\n" for i in range(10) for c in LETTERS)
TRIVIAL = "let a = 1\nlet b = 2;\nvar c: number = 3\nconst x = 4\n"
HAN = "".join(f"text('{'汉字测试文本' * 20}') // {c}\n" for c in LETTERS)
VISIBILITY = "public one()\nprivate two()\n" * 7
IMPORTS = "".join(f"import {{ {c}Part }} from './{c}'\n" for c in LETTERS * 3) + "const fs = require('fs')\n"
COMMENTS = "".join(f"// what {c} does\n# {c}\n* {c}\n" for c in LETTERS * 2)
TESTS = "".join(f"it('does {c}', () => expect({c}))\n" for c in LETTERS * 2)
CONFIG = "".join(f'"{c}": "value",\n' for c in LETTERS * 2)
TEMPLATE = "{{ user.name }} and {{ user.mail }}\n"
LONG = "let total = " + "value + " * 4000 + "0\n"
OWN_HEADER = "// src/Own.ets\nlet own = 1\n"
ESCAPES = 'let s = "a\\\\nb\\\\tc\\qd"\n'
LINKS = "see ![alt](u.png) and ![](v.png) [t](x)\n"
SHORT = "".join(f"let part{c} = {c}(1)\n" for c in LETTERS * 9)
DIGITS = "1 2 3 4.5 -6 7 8 9\n" * 400
#: What comes before a text; None stands for no text at all.
PREFIXES = (
    LICENCE, KEY, HEADER, REPEATED, NUMBERS, "", None, GENERATED, BLANKS, COLONS, TRIVIAL, HAN, VISIBILITY, IMPORTS, COMMENTS, TESTS, CONFIG, TEMPLATE, LONG,
    OWN_HEADER, ESCAPES, LINKS, SHORT, DIGITS,
)


def spread(df: DataFrame) -> DataFrame:
    """A few files with large row groups would keep most cores idle; their rows are dealt out. With as many files as
    cores the scan's own partitions stand, and nothing is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = len(df._jdf.inputFiles())  # counted in the JVM: the names stay there
    return df.repartition(cores) if files < cores else df


def docs(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """doc_id, id, project_name, path, text"""
    d = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    path = F.concat("source", F.lit("/"), "lang", F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".ets"))
    return d.select("doc_id", F.col("doc_id").cast("string").alias("id"), F.col("source").alias("project_name"), path.alias("path"), "text", *more)


def code(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a block of code-like text, by the number, before most texts; one in so many is empty."""
    which = F.col("doc_id") % len(PREFIXES)
    text = F.lit("")
    for i, p in enumerate(PREFIXES):
        text = F.when(which == i, F.lit("") if p is None else F.concat(F.lit(p), F.col("text"))).otherwise(text)
    return docs(spark, sf).withColumn("text", text)


def quoted(s: str) -> str:
    """A string for SQL, in which line feeds are written as they are."""
    return "'" + s.replace("'", "''") + "'"


DOCS_SQL = "select doc_id, doc_id::varchar as id, source as project_name, source || '/' || lang || '/doc_' || doc_id || '.ets' as path, text, lang from documents"
CODE_SQL = f"select doc_id, id, project_name, path, (case doc_id % {len(PREFIXES)} " + " ".join(f"when {i} then {quoted(p or '')} || {chr(39) * 2 if p is None else 'text'}" for i, p in enumerate(PREFIXES)) + f" end) as text from ({DOCS_SQL})"
#: Line arrays as in the filters: this data has line feeds only.
LINES_SQL = f"""
base as (select * from ({CODE_SQL})),
cut as (select *, string_split(text, chr(10)) as raw from base),
lined as (
  select *, case when text = '' then [] when raw[-1] = '' then raw[:-2] else raw end as lines,
         list_filter(list_transform(raw, lambda x: trim(x, ' ' || chr(9))), lambda x: x <> '') as parts
  from cut
),
t as (select *, parts as filled, list_filter(parts, lambda x: not starts_with(x, '//')) as content from lined)
"""
