"""Readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: str | StructType | None = None, limit: int | None = None) -> DataFrame:
    """One JSON object a line; blank and broken lines are skipped. Name a schema at scale: inference reads everything."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    return df if limit is None else df.limit(limit)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_folder(spark: SparkSession, folder: str, schema: str | StructType | None = None) -> DataFrame:
    """The folder's own .jsonl and .json files, with ``file_name``."""
    return read_jsonl(spark, f"{folder.rstrip('/')}/*.{{jsonl,json}}", schema).withColumn("file_name", F.col("_metadata.file_name"))


def read_sources(spark: SparkSession, root: str, suffix: str = ".ets", skip: str | None = None) -> DataFrame:
    """id, path (within the root), project_name (its first folder, or null) and text of every file below the root."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(root, wholetext=True)
    inner = F.substring_index(F.col("_metadata.file_path"), root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
    out = files.select(inner.alias("path"), F.col("value").alias("text"))
    out = out.where(~F.col("path").contains(skip)) if skip else out
    project = F.when(F.col("path").contains("/"), F.substring_index("path", "/", 1))
    return out.select(F.sha2("path", 256).alias("id"), "path", project.alias("project_name"), "text")


def read_lines(spark: SparkSession, path: str, *more: Column) -> DataFrame:
    """(file, line_number from 0, content): the number counts within the file, whose lines one task reads whole."""
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_name").alias("file"), *more, F.posexplode(F.split(F.regexp_replace("value", r"\n\z", ""), "\n", -1)).alias("line_number", "content"))


def summary(df: DataFrame, rows: int = 3) -> dict:
    """Columns, which of them may hold the text, and the first rows."""
    return {"columns": df.columns, "text_like": [c for c in ("text", "content", "code", "llm_formatted") if c in df.columns], "first": [r.asDict() for r in df.limit(rows).collect()]}


def read_markdown(spark: SparkSession, root: str, nested: bool = True) -> DataFrame:
    """Markdown files below the root but for release notes; with ``nested`` off those of the root itself, all of them."""
    if nested:
        return read_sources(spark, root, ".md").where(~F.lower("path").contains("release-notes"))
    files = spark.read.option("pathGlobFilter", "*.md").text(root, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("path"), F.col("value").alias("text"))


def file_check(spark: SparkSession, path: str) -> DataFrame:
    """file_name, megabytes and rows of each JSON-lines file at the path."""
    lines = spark.read.text(path)
    return lines.groupBy(F.col("_metadata.file_name").alias("file_name"), (F.col("_metadata.file_size") / 1e6).alias("megabytes")).agg(F.count("*").alias("rows"))


def jsonl_to_json(spark: SparkSession, path: str, out: str, most: int = 10_000) -> None:
    """A file of JSON lines as one JSON array; a table too large for that is refused, as ``write_report`` does."""
    write_report(read_jsonl(spark, path), out, most)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """With a header, columns in alphabetical order, nested values as JSON."""
    nested = {c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))}
    df.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in sorted(df.columns)]).write.mode("overwrite").option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, column: str) -> None:
    """One folder a value: reasons of rejection, splits, syntax classes."""
    df.write.mode("overwrite").partitionBy(column).json(path)


def write_report(df: DataFrame, path: str, most: int = 10_000) -> None:
    """A small report as one indented JSON file, written through Spark so that any store will do. A table of more than
    ``most`` rows is no report and is refused, as nothing of it may be dropped; write it as JSON lines."""
    import json

    found = df.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rows; write_jsonl takes any number")
    rows = [r.asDict(recursive=True) for r in found]
    df.sparkSession.createDataFrame([(json.dumps(rows, indent=4, ensure_ascii=False, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)
