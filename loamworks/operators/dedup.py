"""Exact duplicates, and near ones by character shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamworks.operators.ordering import checkpointed

PERMUTATIONS = 256
BANDS, ROWS = 13, 19  # what halves the two error integrals at a similarity of 0.85
SHINGLE = 5


def content_hash(text):
    return F.sha2(text, 256)


def exact_dedup(df: DataFrame, *order: str, text_col: str = "text", legacy: bool = False, id_col: str = "id") -> DataFrame:
    """The first row of each text in the order given. A text that a third of all rows share is first reduced in each
    task (grouped minimum), so no window gathers it. With ``legacy`` a dropped id takes all its rows along.

    The rows are written once with their numbers: numbers that were computed anew in each branch of the join could
    differ after a retry, and a group could lose its only row."""
    hashed = checkpointed(df.withColumn("__hash", content_hash(F.col(text_col))).withColumn("__row", F.struct(*order, F.xxhash64(*order), F.monotonically_increasing_id())))
    first = hashed.groupBy("__hash").agg(F.min("__row").alias("__first"))
    if not legacy:
        return hashed.join(first, [hashed["__hash"].eqNullSafe(first["__hash"]), hashed["__row"] == first["__first"]], "left_semi").drop("__hash", "__row")
    dropped = hashed.join(first, "__hash").where(F.col("__row") != F.col("__first")).select(id_col).distinct()
    return df.join(dropped, id_col, "left_anti")


def first_by_name(df: DataFrame, name: str, *order: str) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(name).orderBy(*order))).where("__n = 1").drop("__n")


def _spread(x: np.ndarray) -> np.ndarray:
    """SplitMix64's output function."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signature(text: str | None, a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """MinHash over the set of five-character shingles; None for shorter texts. Each shingle is hashed once, and the
    permutations are multiplications of its 32 bits by odd numbers."""
    if text is None or len(text) < SHINGLE:
        return None
    chars = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    rolled = np.zeros(len(chars) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + chars[k : k + len(rolled)]
    h = np.unique((_spread(rolled) >> np.uint64(32)).astype(np.uint32))
    least = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(h), 512):  # 512 x 256 numbers stay in the cache
        np.minimum(least, (a[:, None] * h[at : at + 512] + b[:, None]).min(1), out=least)
    return least


def near_duplicate_ids(df: DataFrame, *, id_col: str = "id", text_col: str = "text", seed: int = 42) -> DataFrame:
    """Ids of rows that share a band with a row of a smaller id: candidates are not verified, and kept rows do not
    shield others. Each band's smallest id is a grouped minimum, so a bucket of any size is never gathered."""

    def bands(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        rng = np.random.default_rng(seed)
        a = rng.integers(1, 2**32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
        b = rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
        for f in frames:
            out = []
            for i, t in zip(f["id"], f["text"]):
                if (s := signature(t, a, b)) is not None:
                    out.extend((i, k, xxhash.xxh64_intdigest(s[k * ROWS : (k + 1) * ROWS].tobytes()) >> 1) for k in range(BANDS))
            yield pd.DataFrame(out, columns=["id", "band", "key"])

    kind = df.schema[id_col].dataType.simpleString()
    banded = checkpointed(df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInPandas(bands, f"id {kind}, band int, key long"))  # signed once
    least = banded.groupBy("band", "key").agg(F.min("id").alias("least"))
    return banded.join(least, ["band", "key"]).where("id > least").select(F.col("id").alias(id_col)).distinct()


def near_dedup(df: DataFrame, *, id_col: str = "id", text_col: str = "text") -> DataFrame:
    return df.join(near_duplicate_ids(df, id_col=id_col, text_col=text_col), id_col, "left_anti")
