"""Decontamination by path, lookups and anti-joins.

Pattern lists and repository lists are broadcast only after a count. A longer list is joined by the patterns' rarest runs
of up to three characters, so no key meets every pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamworks.operators.clean import leak_key

BROADCAST_ROWS = 200_000
GRAM = 3


def _grams(text: Column, size: int) -> Column:
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: text.substr(i, F.lit(size))))


def containing(keys: DataFrame, key: str, listed: DataFrame, pattern: str) -> DataFrame:
    """The pairs of ``keys`` and ``listed`` (each pattern once) whose key contains the pattern; an empty pattern lies
    within every key. The list is broadcast up to ``BROADCAST_ROWS``; a longer one is joined by hash: each pattern goes to
    the run of its characters that the fewest keys hold, each key to all its runs, and what meets is compared."""
    if listed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return keys.join(F.broadcast(listed), F.expr(f"contains({key}, {pattern})"))
    every = F.broadcast(listed.where(F.col(pattern) == ""))  # a row at most
    out = keys.join(every, F.expr(f"contains({key}, {pattern})"))
    for size in range(1, GRAM + 1):  # patterns shorter than a gram are grams themselves
        own = listed.where(F.length(pattern) == size if size < GRAM else F.length(pattern) >= size)
        spelt = keys.select("*", F.explode(_grams(F.col(key), size)).alias("__gram"))
        often = spelt.groupBy("__gram").agg(F.count("*").alias("__n"))
        rarest = own.select(pattern, F.explode(_grams(F.col(pattern), size)).alias("__gram")).join(often, "__gram", "left").groupBy(pattern).agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), "__gram")).alias("__least"))
        placed = own.join(rarest.where(F.col("__least.n") > 0).select(pattern, F.col("__least.__gram").alias("__gram")), pattern)
        out = out.unionByName(spelt.join(placed, "__gram").where(F.expr(f"contains({key}, {pattern})")).drop("__gram"))
    return out


def leak_path(path: Column, parts: int = 3) -> Column:
    """The path's first components, normalised; null for a path with fewer."""
    pieces = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    return F.when(F.size(pieces) >= parts, leak_key(F.array_join(F.slice(pieces, 1, parts), "/")))


def tag_leaks(df: DataFrame, patterns: DataFrame, *, path_col: str = "path", pattern_col: str = "pattern") -> DataFrame:
    """``leaked``: some pattern lies within the path's first three components. Distinct paths meet the patterns, not rows."""
    listed = patterns.select(leak_key(F.col(pattern_col)).alias("__pattern")).where("__pattern <> ''").distinct()
    keys = df.select(leak_path(F.col(path_col)).alias("__key")).where("__key is not null").distinct()
    bad = containing(keys, "__key", listed, "__pattern").select("__key").distinct().withColumn("__bad", F.lit(True))
    return df.withColumn("__key", leak_path(F.col(path_col))).join(bad, "__key", "left").withColumn("leaked", F.coalesce("__bad", F.lit(False))).drop("__key", "__bad")


def format_join(df: DataFrame, formatted: DataFrame, *, text_col: str = "text", out_col: str = "llm_formatted", order: str = "seq", fallback: bool = True) -> DataFrame:
    """``out_col`` from the last row of ``formatted`` with the same text, else the text itself (or, without
    ``fallback``, null). The join is on hashes: whole texts are compared only where those meet."""
    last = formatted.groupBy(F.sha2(text_col, 256).alias("__hash")).agg(F.max_by(out_col, order).alias(out_col))
    joined = df.drop(out_col).withColumn("__hash", F.sha2(text_col, 256)).join(last, "__hash", "left").drop("__hash")
    return joined.withColumn(out_col, F.coalesce(out_col, text_col)) if fallback else joined


def add_api_version(df: DataFrame, mapping: DataFrame, *, order: str = "seq") -> DataFrame:
    """``api_ver``: the row's own, else that of the first mapping whose id lies within the project name."""
    names = df.select("project_name").where("project_name is not null").distinct()
    listed = mapping.select(F.col("id").cast("string").alias("__id"), F.col("api_ver").alias("__ver"), F.col(order).alias("__order")).where("__id is not null")
    listed = listed.groupBy("__id").agg(F.min_by("__ver", "__order").alias("__ver"), F.min("__order").alias("__order"))
    first = containing(names, "project_name", listed, "__id").groupBy("project_name").agg(F.min_by("__ver", "__order").alias("__found"))
    own = F.col("api_ver") if "api_ver" in df.columns else F.lit(None).cast("string")
    return df.withColumn("__own", own).drop("api_ver").join(first, "project_name", "left").withColumn("api_ver", F.coalesce("__own", "__found")).drop("__own", "__found")


def url_variants(name: Column) -> Column:
    """The name, and the name with one hyphen, each in turn, as a slash."""
    at = F.filter(F.sequence(F.lit(1), F.length(name)), lambda i: name.substr(i, F.lit(1)) == "-")
    return F.array_distinct(F.concat(F.array(name), F.transform(at, lambda i: F.concat(name.substr(F.lit(1), i - 1), F.lit("/"), name.substr(i + 1, F.length(name))))))


def matched_projects(df: DataFrame, repos: DataFrame, *, name_col: str = "project_name", url_col: str = "git_url") -> DataFrame:
    """Distinct project names that some repository's address contains, in any variant."""
    names = df.select(name_col).where(F.col(name_col).isNotNull() & (F.col(name_col) != "")).distinct()
    variants = names.select(name_col, F.explode(url_variants(F.col(name_col))).alias("__v"))
    urls = repos.select(F.col(url_col).alias("__url")).where("__url is not null").distinct()
    if urls.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # an existence join stops at the first address
        return variants.join(F.broadcast(urls), F.expr("contains(__url, __v)"), "left_semi").select(name_col).distinct()
    found = containing(urls, "__url", variants.select("__v").distinct(), "__v").select("__v").distinct()
    return variants.join(found, "__v", "left_semi").select(name_col).distinct()


def url_report(df: DataFrame, repos: DataFrame, *, file_col: str, url_col: str = "repo_url", name_col: str = "project_name") -> DataFrame:
    """Per file and in all (file null): rows, rows without an address, and unmatched projects as rows and as names."""
    known = matched_projects(df, repos, name_col=name_col).withColumn("__known", F.lit(True))
    flagged = df.join(known, name_col, "left").withColumn("__miss", F.when(F.col(name_col).isNotNull() & (F.col(name_col) != "") & F.col("__known").isNull(), F.col(name_col)))
    absent = F.count_if(F.coalesce(F.col(url_col), F.lit("")) == "")
    return flagged.rollup(file_col).agg(F.count("*").alias("rows"), absent.alias("no_url"), F.count("__miss").alias("unmatched"), F.count_distinct("__miss").alias("unmatched_names"))


def not_in(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other table hasn't: set difference by key, and resuming."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def with_originals(judged: DataFrame, originals: DataFrame, key: str) -> DataFrame:
    """The judged rows with the originals' other columns; where both have a column the judged one stands."""
    return judged.join(originals.drop(*[c for c in judged.columns if c != key]), key, "left")


def concatenated(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
