"""Embedding near-duplicates by randomly rotated binary codes with stored correction factors.

A unit vector o of d components is stored, once, as the signs s of its rotations (``CODE_BITS`` of them at least, from as
many rotations as that takes). What the signs stand for, o' = P's / sqrt(bits), is f o + r, r being orthogonal to o in a
direction that the random rotations make uniform. f = <o', o> and |r| are the correction factors, stored with the code.
Each vector has two such codes, of independent rotations. <o', q'> / (f g), with o' of the first code of one vector and
q' of the second code of the other, then estimates <o, q> without bias, and at <o, q> = t its variance is at most
((a + b)(1 - t^2) + a b) / (d - 1), a and b being the squares of |r| / f. Pairs whose upper bound, ``SIGMAS`` above the
estimate, stays below the threshold are dropped; all others are computed exactly, in double precision.

Codes and factors alone are shuffled to find the vectors that have an open pair; only those vectors follow.

Which pairs are estimated: those that agree in the first bits of the code under at least one of several rotations
(sign bits of a random rotation agree with probability 1 - angle/pi, so the number of rotations that a wanted recall
takes is known). The bits follow the number of vectors, so buckets keep their size; a bucket that is larger all the
same is cut into tiles, whose pairs are separate groups of the shuffle. Equal vectors are one class, which counts with
its size and is never expanded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm.components import components, spanning_forest
from loamworks.llm.shared import lean, written

THRESHOLD = 0.93
RECALL = 0.998
SIGMAS = 5.0
#: Signs of a stored code, at least.
CODE_BITS = 256
BUCKET = 512
TILE = 2_048
#: What a group of the shuffle is.
GROUP = ("label_key", "turn", "bucket", "tile_a", "tile_b")
#: Large buckets that are broadcast at most; more are joined by shuffle.
BROADCAST_BUCKETS = 100_000
SEED = 7


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def plan(vectors: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, rotations): buckets of about ``BUCKET`` of so many unrelated vectors, and rotations that let a pair at the
    threshold meet with probability ``recall``."""
    bits = min(30, max(4, math.ceil(math.log2(max(1, vectors) / BUCKET + 1))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def projection(dim: int, seed: int) -> np.ndarray:
    """(dim, bits): rotations side by side, ``CODE_BITS`` wide at least; unit vectors keep their length."""
    many = math.ceil(CODE_BITS / dim)
    return np.concatenate([rotation(dim, seed + r) for r in range(many)], 1) / math.sqrt(many)


def restored(code: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """What packed signs (n, bytes) stand for, in the vectors' own space."""
    bits = turned.shape[1]
    return (np.unpackbits(code, axis=1, count=bits).astype(np.float32) * 2 - 1) @ (turned.T / math.sqrt(bits)).astype(np.float32)


def coded(unit: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, f, (|r| / f) squared) of unit vectors."""
    code = np.packbits(unit @ turned > 0, axis=1)
    o = restored(code, turned).astype(float)
    f = (o * unit).sum(1)
    return code, f, np.maximum(0.0, (o * o).sum(1) - f * f) / (f * f)


@lru_cache(8)  # lengths are few; of many, matrices are made anew
def code_matrices(dim: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    return projection(dim, seed + 1_000_000), projection(dim, seed + 2_000_000)


@lru_cache(8)
def bucket_matrices(dim: int, bits: int, rotations: int, seed: int) -> list[np.ndarray]:
    return [rotation(dim, seed + t)[:, : min(bits, dim)] for t in range(rotations)]


def _coder(bits: int, rotations: int, seed: int):
    """(class_key, size, label_key, embedding) -> the same with its code (both, one after the other), factors (f of each,
    and the larger of their errors) and the bucket of each rotation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = pa.compute.list_value_length(b.column("embedding")).to_numpy()
            for dim in np.unique(length).tolist():
                part = b.filter(pa.array(length == dim))
                x = _unit(part.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim))
                (first, second), turns = code_matrices(dim, seed), bucket_matrices(dim, bits, rotations, seed)
                (one, f, a), (two, g, c) = coded(x, first), coded(x, second)
                weights = 1 << np.arange(min(bits, dim))
                codes = np.stack([((x @ t) > 0) @ weights for t in turns], 1).astype(np.int32)
                both = np.concatenate([one, two], 1)
                cuts = pa.array(np.arange(len(x) + 1) * both.shape[1], pa.int32())
                made = [
                    pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, cuts.buffers()[1], pa.py_buffer(np.ascontiguousarray(both))]),
                    pa.array(np.full(len(x), dim, np.int32)),
                    *(pa.array(v.astype(np.float32)) for v in (f, g, np.maximum(a, c))),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * rotations, pa.int32()), pa.array(codes.ravel())),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "code", "dim", "f", "g", "error", "codes"])

    return run


def open_pairs(first: np.ndarray, second: np.ndarray, error: np.ndarray, dim: int, threshold: float, rows: slice, begin: int) -> np.ndarray:
    """Whether the upper bound of <o, q> reaches the threshold, for the vectors ``rows`` and those from ``begin`` on.
    first, second: what the two codes stand for, over f; error: the larger of their (|r| / f) squared."""
    estimate = (first[rows] @ second[begin:].T + second[rows] @ first[begin:].T) / 2
    a, b = error[rows, None], error[None, begin:]
    spread = np.sqrt(((a + b) * (1 - threshold**2) + a * b) / max(1, dim - 1))
    return estimate + SIGMAS * spread >= threshold - 1e-5


def exact_links(x: np.ndarray, codes: np.ndarray, turn: int, split: int | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows at the threshold or above that share no earlier rotation's bucket. With ``split``, i lies
    before and j from it on; else all pairs."""
    unit = _unit(x)
    found_i, found_j = [], []
    last = len(x) if split is None else split
    for at in range(0, last, 512):
        begin = at if split is None else split
        i, j = np.nonzero(unit[at : min(at + 512, last)] @ unit[begin:].T >= threshold - 1e-9)
        i, j = i + at, j + begin
        ok = i < j
        i, j = i[ok], j[ok]
        exact = np.empty(len(i))
        for s in range(0, len(i), 100_000):
            exact[s : s + 100_000] = np.einsum("ij,ij->i", unit[i[s : s + 100_000]], unit[j[s : s + 100_000]])
        ok = exact >= threshold
        i, j = i[ok], j[ok]
        for s in range(turn):
            if len(i):
                ok = codes[i, s] != codes[j, s]
                i, j = i[ok], j[ok]
        found_i.append(i)
        found_j.append(j)
    return np.concatenate(found_i), np.concatenate(found_j)


def _split(t: pa.Table) -> int | None:
    return int(np.searchsorted(t["half"].to_numpy(), 1)) if t["cross"][0].as_py() else None


def _opener(threshold: float, seed: int):
    """Rows of codes of one group -> the rows that have an open pair in it."""

    def close(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        if t.num_rows < 2:
            return
        dim, split = t["dim"][0].as_py(), _split(t)
        raw = np.frombuffer(b"".join(t["code"].to_pylist()), np.uint8).reshape(t.num_rows, -1)
        half = raw.shape[1] // 2
        one, two = (restored(np.ascontiguousarray(c), m) / t[f].to_numpy()[:, None] for c, m, f in zip((raw[:, :half], raw[:, half:]), code_matrices(dim, seed), "fg"))
        error = t["error"].to_numpy()
        some = np.zeros(t.num_rows, bool)
        last = t.num_rows if split is None else split
        for at in range(0, last, 512):
            rows_of = slice(at, min(at + 512, last))
            begin = at if split is None else split
            hit = open_pairs(one, two, error, dim, threshold, rows_of, begin)
            if split is None:
                hit = np.triu(hit, 1)
            some[rows_of] |= hit.any(1)
            some[begin:] |= hit.any(0)
        if some.any():
            kept = t.select([*GROUP, "half", "cross", "class_key"]).filter(pa.array(some))
            yield from kept.combine_chunks().to_batches()

    return _by_group(close)


def _joiner(threshold: float):
    """Rows with vectors of one group -> for each class its links' sizes (b null), and a forest of the links."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def close(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows)
        key = t["class_key"].to_numpy()
        if len(key) < 2:
            return
        x = t["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(key), -1)
        codes = t["codes"].combine_chunks().flatten().to_numpy().reshape(len(key), -1)
        size = t["size"].to_numpy()
        i, j = exact_links(x, codes, t["turn"][0].as_py(), _split(t), threshold)
        if not len(i):
            return
        links = np.bincount(i, size[j], len(key)) + np.bincount(j, size[i], len(key))
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.nulls(len(some), pa.int64()), pa.array(links[some].astype(np.int64))], schema=schema)
        a, b = spanning_forest(key[i], key[j])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), np.int64))], schema=schema)

    return _by_group(close)


def _by_group(close):
    """A function for mapInArrow over rows sorted by ``GROUP``: each group's batches go to ``close``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group = None
        for b in batches:
            if not b.num_rows:
                continue
            g = np.stack([b.column(c).to_numpy() for c in GROUP], 1)
            cuts = [0, *(np.flatnonzero((g[1:] != g[:-1]).any(1)) + 1), len(g)]
            for s, e in zip(cuts, cuts[1:]):
                if group is not None and tuple(g[s]) != group:
                    yield from close(held)
                    held = []
                group = tuple(g[s])
                held.append(b.slice(s, e - s))
        if held:
            yield from close(held)

    return run


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Rows link when their labels are equal and not null and their cosine is ``threshold`` or more. Vectors that are
    null, empty, zero or hold null or non-finite components, and vectors of another length than a label's others, link
    with nothing: n_links 0, component their own id. Repeated rows are other vectors and link with each other. A group
    takes the smallest id; a group of null ids alone has a null component, and is not kept. Ties in cosine do not
    matter. An empty table gives no rows. Other columns are not read.
    """
    slim = vectors.select(vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), vectors[vector_col].alias("embedding"))
    number = slim.schema["embedding"].dataType.elementType.simpleString()
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("embedding", lambda v: v != 0)
    slim = slim.withColumn("ok", F.coalesce(F.col("label").isNotNull() & finite, F.lit(False)))
    # -0.0 and 0.0 are one value; a class is one vector under one label
    usable = slim.where("ok").withColumn("embedding", F.transform("embedding", lambda v: (v + F.lit(0).cast(number)).cast(number)))
    # 128 bits stand for a class in joins, so that whole vectors are no join keys
    hashes = [F.xxhash64("label", "embedding").alias("h"), F.xxhash64(F.lit(seed), "embedding", "label").alias("k")]
    classes = usable.groupBy("label", "embedding").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
    classes = written(classes.select("embedding", "size", "least", *hashes, F.monotonically_increasing_id().alias("class_key"), F.xxhash64("label", F.size("embedding")).alias("label_key")), "classes")
    most = classes.groupBy("label_key").count().agg(F.max("count")).first()[0] or 0
    found = written(_links(classes, *plan(most, threshold, recall), threshold, seed), "links")
    linked = components(found.where("b is not null").select("a", "b"))
    degrees = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "class_key")
    rooted = written(classes.select("class_key", "h", "k", "size", "least").join(linked, F.col("class_key") == F.col("vertex"), "left").withColumn("root", F.coalesce("component", "class_key")), "rooted")
    # written, so that the join's sides are shuffled for it alone and a component of any size can be split
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    whole = rooted.join(least, "root").join(degrees, "class_key", "left").select("h", "k", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    members = usable.select("vec_id", *hashes).join(whole, ["h", "k"]).select("vec_id", "n_links", "component_id")
    alone = slim.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return members.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(classes: DataFrame, bits: int, rotations: int, threshold: float, seed: int) -> DataFrame:
    plain = "class_key long, size long, label_key long, embedding " + classes.schema["embedding"].dataType.simpleString()
    kept = written(classes.select("class_key", "size", "label_key", "embedding").mapInArrow(lean(_coder(bits, rotations, seed)), f"{plain}, code binary, dim int, f float, g float, error float, codes array<int>"), "codes")
    rows = kept.select("class_key", "label_key", "dim", "code", "f", "g", "error", F.posexplode("codes").alias("turn", "bucket")).withColumns({"turn": F.col("turn").cast("long"), "bucket": F.col("bucket").cast("long")})
    place = list(GROUP[:3])
    large = written(rows.groupBy(*place).count().where(F.col("count") > TILE).select(*place, F.ceil(F.col("count") / TILE).alias("tiles")), "tiles")
    if large.count() <= BROADCAST_BUCKETS:
        large = F.broadcast(large)
    rows = rows.join(large, place, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    mine = F.pmod(F.xxhash64("class_key"), F.col("tiles"))
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    marks = {"tile_a": F.least("mine", "other"), "tile_b": F.greatest("mine", "other"), "half": (F.col("mine") > F.col("other")).cast("int"), "cross": F.col("mine") != F.col("other")}
    dealt = rows.withColumns(marks).select("class_key", "dim", "code", "f", "g", "error", *GROUP, "half", "cross")
    together = lambda df: df.repartition(*GROUP).sortWithinPartitions(*GROUP, "half")
    at = "label_key long, turn long, bucket long, tile_a long, tile_b long, half int, cross boolean, class_key long"
    opened = together(dealt).mapInArrow(lean(_opener(threshold, seed)), at)
    vectors = opened.join(kept.select("class_key", "size", "embedding", "codes"), "class_key")
    return together(vectors).mapInArrow(lean(_joiner(threshold)), "a long, b long, n long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All pairs within a label: fit for the small tables that the SQL check reads.
ORACLE_SQL = """
with v as (
  select row_number() over () as r, vec_id, label, embedding::double[] as e from embeddings
), u as (
  select *, sqrt(list_sum(list_transform(e, lambda x: x * x))) as norm from v
  where label is not null and e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
  select a.r as a, b.r as b from u a join u b on a.label = b.label and a.r <> b.r and len(a.e) = len(b.e)
  where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), recursive_reach as (
  with recursive reach(a, b) as (
    select r, r from v union select reach.a, links.b from reach join links on reach.b = links.a
  ) select a, b from reach
), comp as (
  select reach.a as r, min(v.vec_id) as component_id from recursive_reach reach join v on v.r = reach.b group by 1
), deg as (select a as r, count(*) as n from links group by 1)
select v.vec_id, coalesce(deg.n, 0)::bigint as n_links, comp.component_id, coalesce(v.vec_id = comp.component_id, false) as kept
from v join comp using (r) left join deg using (r)
"""
