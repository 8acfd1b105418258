"""Sampling, splitting and mixing (M1 to M13, W2 to W5). Random orders are hashes of a seed and the row's id."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamworks.operators.ordering import checkpointed, random_key, ranked


def random_sample(df: DataFrame, n: int, *, id_col: str = "id", seed: int = 42) -> DataFrame:
    return df.orderBy(random_key(seed, id_col), id_col).limit(n)


def length_bucket(length: Column) -> Column:
    return F.when(length < 200, "<200").when(length < 800, "200-799").when(length < 2000, "800-1999").when(length < 6000, "2000-5999").otherwise(">=6000")


def allocation(sizes: dict[tuple, int], n: int) -> dict[tuple, int]:
    """Rows a stratum: its floor share of ``n``, one at least and all it has at most; what is left goes round, the most
    spare first. The rule for counts that are at hand; ``quotas`` applies it to a table."""
    total = sum(sizes.values())
    if n >= total:
        return dict(sizes)
    got = {k: min(size, max(1, math.floor(size / total * n))) for k, size in sizes.items()}
    left = n - sum(got.values())
    while left > 0:
        spare = sorted((k for k in sizes if got[k] < sizes[k]), key=lambda k: (got[k] - sizes[k], k))
        for k in spare[:left]:
            got[k] += 1
        left = n - sum(got.values())
    return got


#: Strata whose quotas are broadcast at most; more are joined by a shuffle.
BROADCAST_STRATA = 100_000


def quotas(df: DataFrame, n: int, strata: list[str]) -> DataFrame:
    """The strata and ``quota``: the floor share of ``n``, one at least and all that a stratum has at most; what is left
    goes one each to those with the most spare rows, ties by their names, null first. What is left is less than the
    strata with spare rows, so one turn is enough."""
    sizes = checkpointed(df.groupBy(*strata).agg(F.count("*").alias("__size")))
    total = sizes.agg(F.sum("__size")).first()[0] or 0
    if n >= total:
        return sizes.withColumnRenamed("__size", "quota")
    base = sizes.withColumn("quota", F.least("__size", F.greatest(F.lit(1), F.floor(F.col("__size") / F.lit(float(total)) * F.lit(n)))))
    left = max(0, n - base.agg(F.sum("quota")).first()[0])
    names = [key for c in strata for key in (F.col(c).isNotNull(), F.col(c).cast("string"))]
    more = base.where("quota < __size").orderBy(F.col("quota") - F.col("__size"), *names).limit(left).withColumn("quota", F.lit(1).cast("long"))
    return base.unionByName(more).groupBy(*strata).agg(F.sum("quota").alias("quota"))


def stratified_sample(df: DataFrame, n: int, strata: list[str], *, id_col: str = "id", seed: int = 42) -> DataFrame:
    """At most ``n`` rows, as many of each stratum as ``quotas`` gives it; null is a stratum of its own. An empty table
    gives no rows. Any number of strata will do."""
    quota = checkpointed(quotas(df, n, strata)).withColumnRenamed("quota", "__quota")
    if quota.count() <= BROADCAST_STRATA:
        quota = F.broadcast(quota)
    # no quota is above n, so each task stops at n rows of a stratum before the shuffle
    first = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*strata).orderBy(random_key(seed, id_col), id_col))).where(F.col("__rank") <= n)
    picked = first.join(quota, [first[c].eqNullSafe(quota[c]) for c in strata]).where(F.col("__rank") <= F.col("__quota"))
    return picked.select(*[first[c] for c in df.columns]).orderBy(random_key(seed, id_col)).limit(n)


def ratio_split(df: DataFrame, n: int, ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), *, id_col: str = "id", seed: int = 42) -> DataFrame:
    """A sample of n rows with ``split``: sizes are cut to whole rows, the test split has the rest."""
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("the ratios must sum to 1")
    n = min(n, df.count())
    train, valid = int(n * ratios[0]), int(n * ratios[1])
    at = F.col("position")
    split = F.when(at < train, "train").when(at < train + valid, "valid").otherwise("test")
    return ranked(df, random_key(seed, id_col), id_col).where(at < n).withColumn("split", split)


def token_budget(df: DataFrame, budget: int, *, tokens: str = "text_tokens", id_col: str = "id", seed: int = 42) -> DataFrame:
    """Rows in random order until their tokens reach the budget; the row that crosses it is in."""
    return ranked(df, random_key(seed, id_col), id_col, weight=F.col(tokens)).where(F.col("ahead") < budget).drop("position", "ahead")


def assign_splits(df: DataFrame, *, test_tokens: int = 1_000_000, valid_tokens: int = 100_000, tokens: str = "text_tokens", id_col: str = "id") -> DataFrame:
    """``split``: rows that leak are unused, but for test and then validation rows drawn from them; others train."""
    # ids and token counts alone are ordered, and computed once
    leaked = checkpointed(df.where("leaked").select(id_col, tokens))
    test = token_budget(leaked, test_tokens, tokens=tokens, id_col=id_col, seed=42).select(F.col(id_col).alias("__id")).distinct().withColumn("__split", F.lit("test"))
    rest = leaked.join(test, F.col(id_col) == F.col("__id"), "left_anti")
    valid = token_budget(rest, valid_tokens, tokens=tokens, id_col=id_col, seed=43).select(F.col(id_col).alias("__id")).distinct().withColumn("__split", F.lit("valid"))
    return df.join(test.unionByName(valid), F.col(id_col) == F.col("__id"), "left").withColumn("split", F.coalesce("__split", F.when(F.col("leaked"), "unused").otherwise("train"))).drop("__id", "__split")


def nested_sizes(df: DataFrame, budgets: dict[str, int], *, tokens: str = "text_tokens", id_col: str = "id", seed: int = 42) -> DataFrame:
    """One flag column a budget, from one running sum: each smaller set is the start of the larger."""
    out = ranked(df, random_key(seed, id_col), id_col, weight=F.col(tokens))
    return out.withColumns({name: F.col("ahead") < budget for name, budget in budgets.items()}).drop("position", "ahead")


def ratio_mix(main: DataFrame, other: DataFrame, ratio: float = 0.8, *, id_col: str = "id", seed: int = 42) -> DataFrame:
    """All of ``main`` and as many of ``other`` as make main's share ``ratio``, in random order."""
    n = main.count()
    picked = random_sample(other, round(n / ratio) - n, id_col=id_col, seed=seed)
    return main.unionByName(picked, allowMissingColumns=True).orderBy(random_key(seed, id_col), id_col)


def blocks(df: DataFrame, n: int, *order: str) -> DataFrame:
    """``block`` from 0: consecutive blocks, the first ones a row longer where the rows don't divide."""
    rows = df.count()
    small, longer = divmod(rows, n)
    at, edge = F.col("position"), longer * (small + 1)
    block = F.when(at < edge, F.floor(at / (small + 1))).otherwise(longer + F.floor((at - edge) / max(1, small)))
    return ranked(df, *order).withColumn("block", block.cast("long")).drop("position")


def block_mix(main: DataFrame, other: DataFrame, n: int, *, order: str = "id", id_col: str = "id", seed: int = 42) -> DataFrame:
    """Both corpora in n blocks each, joined block by block and shuffled within a block."""
    both = blocks(main, n, order).unionByName(blocks(other, n, order), allowMissingColumns=True)
    return both.orderBy("block", random_key(seed, id_col), id_col)


def interleave(first: DataFrame, second: DataFrame, order: str) -> DataFrame:
    """Two sources spread evenly over one order, ``place`` from 0; where both are due the first source goes first."""
    parts = []
    for tag, df in enumerate((first, second)):
        n = max(1, df.count())
        parts.append(ranked(df, order).withColumn("__due", F.col("position") / n).withColumn("__source", F.lit(tag)).drop("position"))
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return ranked(both, "__due", "__source").withColumnRenamed("position", "place").drop("__due", "__source")
