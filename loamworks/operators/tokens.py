"""Token counts, ranges, histograms and label or language counters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def word_tokens(text: Column) -> Column:
    """The tokenizer at hand by default: words and single marks."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]")).cast("long")


def tokens_by(encoder: Callable[[], Callable[[str], list]]) -> Callable[[Column], Column]:
    """Counts by a tokenizer that ``encoder()`` makes once a worker; empty and null texts have none."""

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder()
        for s in texts:
            yield s.map(lambda t: len(encode(t)) if t else 0)

    return count


def token_stats(df: DataFrame, tokens: str = "text_tokens", text_col: str = "text") -> DataFrame:
    empty = F.coalesce(F.col(text_col), F.lit("")) == ""
    total, n, none = F.coalesce(F.sum(tokens), F.lit(0)), F.count("*"), F.count_if(empty)
    return df.agg(total.alias("total_tokens"), n.alias("entries"), none.alias("empty_entries"), F.round(F.coalesce(F.try_divide(total.cast("double"), (n - none).cast("double")), F.lit(0.0)), 2).alias("avg_tokens"))


def chars_per_1000_tokens(df: DataFrame, order: str, rows: int = 10, tokens: str = "text_tokens", text_col: str = "text") -> DataFrame:
    first = df.orderBy(order).limit(rows)
    return first.agg(F.round(F.try_divide(F.sum(F.length(text_col)).cast("double") * 1000, F.sum(tokens).cast("double")), 6).alias("chars_per_1000"))


def in_ranges(df: DataFrame, ranges: tuple[tuple[int, int], ...], tokens: str = "text_tokens") -> DataFrame:
    """A row for each range that a row's tokens lie in, both ends included; ranges may overlap."""
    all_ranges = F.array(*[F.struct(F.lit(a).alias("low"), F.lit(b).alias("high")) for a, b in ranges])
    return df.withColumn("range", F.explode(F.filter(all_ranges, lambda r: F.col(tokens).between(r["low"], r["high"])))).select("*", F.concat("range.low", F.lit("-"), "range.high").alias("token_range")).drop("range")


def first_per_range(df: DataFrame, ranges: tuple[tuple[int, int], ...], order: str, rows: int = 5, tokens: str = "text_tokens") -> DataFrame:
    ranked = in_ranges(df, ranges, tokens).withColumn("rank", F.row_number().over(Window.partitionBy("token_range").orderBy(order)))
    return ranked.where(F.col("rank") <= rows)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """n and percent of each value; the total comes from the few counts, not from the rows."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))
    return counts.join(F.broadcast(total)).select(column, "n", F.round(100.0 * F.col("n") / F.col("__total"), 6).alias("percent"))


def length_histogram(df: DataFrame, bins: int = 50, text_col: str = "text") -> DataFrame:
    """Rows in each of ``bins`` equal bins between the shortest and the longest text."""
    ends = F.broadcast(df.agg(F.min(F.length(text_col)).cast("double").alias("__low"), F.max(F.length(text_col)).cast("double").alias("__high")))
    place = F.least(F.lit(bins - 1), F.floor((F.length(text_col) - F.col("__low")) * bins / F.greatest(F.lit(1e-9), F.col("__high") - F.col("__low"))))
    return df.join(ends).groupBy(place.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def split_stats(df: DataFrame, column: str = "split") -> DataFrame:
    known = F.lower(F.col(column))
    return df.groupBy(F.when(known.isin("train", "valid", "test", "unused"), known).otherwise("unknown").alias("split")).agg(F.count("*").alias("n"))
