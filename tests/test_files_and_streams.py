"""Readers, writers, streams, and tables that are empty or hold nulls."""

import json

from pyspark.sql import functions as F

from loamworks.operators import dedup, joins, tokens
from loamworks.sources import files
from loamworks.streaming import clean_stream


def test_jsonl_round_trip(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "text": "x"}\n\nbroken\n{"id": "2", "text": "é"}\n')
    df = files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "id string, text string")
    assert sorted(map(tuple, df.collect())) == [("1", "x"), ("2", "é")]
    files.write_jsonl(df, str(tmp_path / "out"))
    files.write_jsonl(df, str(tmp_path / "out"), append=True)
    assert spark.read.json(str(tmp_path / "out")).count() == 4
    files.write_csv(df.withColumn("labels", F.array(F.lit("a"))), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["id", "labels", "text"]
    files.write_partitioned(df.withColumn("split", F.lit("train")), str(tmp_path / "parts"), "split")
    assert (tmp_path / "parts" / "split=train").exists()
    files.write_report(df, str(tmp_path / "report"))
    assert len(json.loads("\n".join(r[0] for r in spark.read.text(str(tmp_path / "report")).collect()))) == 2


def test_sources_and_lines(spark, tmp_path):
    (tmp_path / "root" / "proj" / "src").mkdir(parents=True)
    (tmp_path / "root" / "proj" / "src" / "a.ets").write_text("let a\nlet b\n")
    (tmp_path / "root" / "top.ets").write_text("x")
    (tmp_path / "root" / "b.ts").write_text("x")
    got = sorted(((r["path"], r["project_name"]) for r in files.read_sources(spark, str(tmp_path / "root")).collect()))
    assert got == [("proj/src/a.ets", "proj"), ("top.ets", None)]
    assert [(r["line_number"], r["content"]) for r in files.read_lines(spark, str(tmp_path / "root/proj/src/a.ets")).collect()] == [(0, "let a"), (1, "let b")]


def test_cleaning_on_a_stream(spark, tmp_path):
    files.write_jsonl(spark.createDataFrame([("a.ets", "\nlet total = 1"), ("b.ets", None)], "path string, text string"), str(tmp_path / "in"))
    stream = spark.readStream.schema("path string, text string").json(str(tmp_path / "in"))
    q = clean_stream.cleaned(stream).writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert spark.table("cleaned").count() == 2


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b"), (None, None), (4, None)], "id int, text string")
    assert sorted((r["text"] or "", r["id"] or 0) for r in dedup.exact_dedup(df, "id").collect()) == [("", 0), ("a", 1), ("b", 3)]


def test_near_dedup(spark):
    base = " ".join(f"word{i}" for i in range(300))
    df = spark.createDataFrame([(1, base), (2, base + " more"), (3, "something else entirely " * 9), (4, "abc"), (5, "abc")], "id int, text string")
    assert sorted(r["id"] for r in dedup.near_dedup(df).collect()) == [1, 3, 4, 5]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id string, text string, path string, project_name string")
    assert dedup.exact_dedup(none, "id").count() == 0 and dedup.near_dedup(none).count() == 0
    assert joins.tag_leaks(none, spark.createDataFrame([], "pattern string")).count() == 0
    assert tokens.token_stats(none.withColumn("text_tokens", F.lit(1))).first()["total_tokens"] == 0
