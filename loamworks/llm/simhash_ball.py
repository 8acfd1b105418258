"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints are within ``radius`` bits exactly if some variant lies within half the radius of both. Every
fingerprint emits all its variants within half the radius; equal variants meet. To keep the shuffle small a variant's
first bits are its shuffle key: a fingerprint travels once to each key that its variants have, and the receiving task
makes the variants themselves, in blocks by their next bits, each halved until it is small enough, so a task holds no more
variants for a large share or for one large group of near copies. All
members of one variant are within the radius of each other, so a star links them without loss; links are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loamworks.llm.components import components, spanning_forest
from loamworks.llm.shared import lean, written

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
_CHUNK = 1 << 16
#: Variants, and links not yet merged, that a task holds at once.
BLOCK_VARIANTS = 1_000_000


def fingerprint(text: bytes, words: int = SHINGLE, seed: int = SEED) -> int:
    """Majority of the bits of the shingles' XXH64 (over half must be set). No words: 0."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()  # of bytes: A-Z, and space and \\x09-\\x0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size + 1) - 1
    start, stop = (end - size)[: 1 - words].tolist(), end[words - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(start), _CHUNK):
        h = np.array([xxh64_intdigest(joined[i:j], seed) for i, j in zip(start[at : at + _CHUNK], stop[at : at + _CHUNK])], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(start), bitorder="little").view(np.uint64)[0])


def _fingerprints(columns: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([fingerprint((t.as_py() or "").encode()) for t in b.column(text_col)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pa.array(got, pa.int64())], names=[*columns, "fp"])

    return run


@cache
def _masks(bits: int, flips: int) -> np.ndarray:
    """All masks of at most ``flips`` of the lowest ``bits`` bits."""
    return np.array([sum(1 << i for i in c) for k in range(flips + 1) for c in combinations(range(bits), k)], np.uint64)


def _n_variants(bits: int, flips: int, spent: np.ndarray) -> int:
    """Variants in the lowest ``bits`` bits of fingerprints that have spent so many of ``flips`` flips."""
    own = np.bincount(spent[spent <= flips], minlength=flips + 1).tolist()
    return sum(n * sum(comb(bits, i) for i in range(flips - k + 1)) for k, n in enumerate(own))


def _ball_links(half: int, radius: int, prefix: int):
    """Rows (key, fp), sorted by key -> a forest of the links between fingerprints that share a variant with that key."""
    low = BITS - prefix

    def blocks(key: int, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All (variants, their fingerprints' places) under the key, at most ``BLOCK_VARIANTS`` at once however alike the
        fingerprints are: a block is halved by its next bit until it is small enough, or is one variant."""
        places = np.arange(len(fps), dtype=np.int32)
        todo = [(prefix, key, places, np.bitwise_count((fps >> np.uint64(low)) ^ np.uint64(key)))]
        while todo:
            depth, lead, mine, spent = todo.pop()
            left = BITS - depth
            if left and _n_variants(left, half, spent) > BLOCK_VARIANTS:
                bit = (fps[mine] >> np.uint64(left - 1) & np.uint64(1)).astype(np.uint8)
                parts = []
                for side in (0, 1):
                    after = spent + (bit != side)
                    fit = after <= half
                    parts.append((depth + 1, lead << 1 | side, mine[fit], after[fit]))
                # the smaller part is done first, so that what waits does not pile up
                todo += sorted((x for x in parts if len(x[2])), key=lambda x: -_n_variants(left - 1, half, x[3]))
                continue
            variant, owner = [], []
            for k in range(half + 1):
                those = mine[spent == k]
                if len(those):
                    masks = _masks(left, half - k)
                    start = (np.uint64(lead) << np.uint64(left)) | (fps[those] & np.uint64((1 << left) - 1))
                    variant.append((start[:, None] ^ masks).ravel())
                    owner.append(np.repeat(those, len(masks)))
            if variant:
                yield np.concatenate(variant), np.concatenate(owner)

    def links(key: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fps = np.unique(fps)
        if len(fps) < 2:
            return fps[:0], fps[:0]
        a = b = np.empty(0, np.int64)  # the forest so far, and the blocks' forests that are not yet in it
        found, n_found = [], 0
        for v, o in blocks(key, fps):
            order = np.argsort(v, kind="stable")
            v, o = v[order], o[order]
            same = v[1:] == v[:-1]
            x, y = o[:-1][same].astype(np.int64), o[1:][same].astype(np.int64)  # neighbours in a run link the whole run
            if len(x):
                pair = np.unique(np.minimum(x, y) * len(fps) + np.maximum(x, y))
                x, y = pair // len(fps), pair % len(fps)
                true = np.bitwise_count(fps[x] ^ fps[y]) <= radius
                found.append(spanning_forest(x[true], y[true]))
                n_found += len(found[-1][0])
                if n_found > BLOCK_VARIANTS:
                    a, b = spanning_forest(*map(np.concatenate, zip((a, b), *found)))
                    found, n_found = [], 0
        a, b = spanning_forest(*map(np.concatenate, zip((a, b), *found)))
        return fps[a], fps[b]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []

        def close() -> pd.DataFrame:
            a, b = links(key, np.concatenate(held))
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for f in frames:
            keys, fps = f["key"].to_numpy(np.int64), f["fp"].to_numpy(np.int64).view(np.uint64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for ks, part in zip(np.split(keys, cuts), np.split(fps, cuts)):
                if len(ks) == 0:
                    continue
                if key is not None and ks[0] != key:
                    yield close()
                    held = []
                key = int(ks[0])
                held.append(part)
        if held:
            yield close()

    return run


def with_fingerprints(docs: DataFrame, *, text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """The ``extra`` columns and ``fp`` (the fingerprint as a long) for every row; 0 for null, empty and wordless texts.
    Repeated rows stay repeated, an empty table gives no rows, other columns are not read."""
    return docs.select(*extra, text_col).mapInArrow(lean(_fingerprints(list(extra), text_col)), ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra), "fp long"]))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row.

    Null and empty texts and texts without words have fingerprint 0 and are linked like any other. Repeated rows and
    ids are one vertex; a null id belongs to its fingerprint's group but is never the smallest id, so a group of null
    ids alone has component_id null. An empty table gives no rows. Other columns are not read.
    """
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    prints = written(with_fingerprints(slim, extra=("doc_id",)), "fingerprints")
    groups = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "groups")
    linked = components_of_groups(groups, radius)
    # docs of one fingerprint may be a third of all rows: a join, unlike a grouping, can be split by Spark at run time.
    return prints.join(linked, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def components_of_groups(groups: DataFrame, radius: int) -> DataFrame:
    """(fp, least) -> (fp, root, least), the smallest ``least`` of the fingerprint's component and its root fingerprint."""
    linked = components(fingerprint_edges(groups, radius))
    joined = written(groups.join(linked, groups.fp == linked.vertex, "left").select("fp", "least", F.coalesce("component", "fp").alias("root")), "rooted")
    # written, so that the join's sides are shuffled for it alone and a component of any size can be split
    whole = written(joined.groupBy("root").agg(F.min("least").alias("least")), "roots")
    return joined.select("fp", "root").join(whole, "root")


def fingerprint_edges(groups: DataFrame, radius: int, prefix: int | None = None) -> DataFrame:
    half = (radius + 1) // 2
    if prefix is None:  # follows the number of fingerprints, so that a key keeps some 50,000 of them whatever that is
        prefix = min(40, max(4, (groups.count() // 50_000).bit_length() + 4))
    masks = F.array(*[F.lit(int(m)) for m in _masks(prefix, half)])
    keyed = groups.select("fp", F.explode(F.transform(masks, lambda m: F.shiftrightunsigned("fp", BITS - prefix).bitwiseXOR(m))).alias("key"))
    return keyed.repartition("key").sortWithinPartitions("key").mapInPandas(lean(_ball_links(half, radius, prefix)), "a long, b long")


#: Dropped rows whose numbers are broadcast at most; more are taken out by a shuffled join.
BROADCAST_ROWS = 1_000_000


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows, with all their columns, less all but one of each component: the row with the smallest id stays (null
    ids last; of repeated rows any one, the same each time it is read)."""
    at = docs.columns.index(text_col)
    kind = StructType([StructField("doc", docs.schema), StructField("fp", LongType())])  # no DDL text: names may hold anything

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = np.array([fingerprint((t.as_py() or "").encode()) for t in b.column(0).field(at)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.int64())], names=["doc", "fp"])

    # The rows go into one column, so none of theirs can clash; written once, as their numbers must stay the same.
    named = [docs["`" + c.replace("`", "``") + "`"] for c in docs.columns]
    packed = docs.select(F.struct(*named).alias("doc")).mapInArrow(lean(run), kind)
    held = written(packed.withColumn("row", F.monotonically_increasing_id()), "rows")
    own = F.col("doc").getField(id_col)
    slim = held.select("row", "fp", F.struct(own.isNull().alias("no_id"), own.alias("id"), "row").alias("least"))
    groups = written(slim.groupBy("fp").agg(F.min("least").alias("least")), "groups")
    linked = components_of_groups(groups, radius).select("fp", F.col("least.row").alias("stays"))
    drop = written(slim.select("row", "fp").join(linked, "fp").where("row <> stays").select("row"), "dropped")
    if drop.count() <= BROADCAST_ROWS:
        drop = F.broadcast(drop)
    return held.join(drop, "row", "left_anti").select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
