"""Token ids packed best-fit decreasing into fixed-length rows.

Documents are encoded by byte-level BPE, cut losslessly into segments of at most ``length`` ids, and the segments of
a bounded window of the task's rows are packed best-fit decreasing: a segment tree over remaining capacities finds the
tightest open row in log2(length) steps. No row leaves its task, so there is no shuffle, and a task that runs again on
the same input split makes the same rows. Memory: one window of ids, whatever the input.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from loamworks.llm.shared import lean

LENGTH = 2048
WINDOW_TOKENS = 4_000_000
PACKED = (
    "pack_id long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, row_ids array<long>, seg_offsets array<long>"
)


class CapacityTree:
    """For each remaining capacity, the open bins that have it; finds the least capacity that holds a size."""

    def __init__(self, length: int) -> None:
        self.base = 1 << length.bit_length()
        self.live = bytearray(2 * self.base)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def put(self, capacity: int, bin_no: int) -> None:
        self.bins[capacity].append(bin_no)
        node = capacity + self.base
        while node and not self.live[node]:
            self.live[node] = 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, bin) of the tightest fit, removed from the tree; None if no open bin holds ``size``."""
        live, node = self.live, size + self.base
        if not live[node]:
            while node > 1 and (node & 1 or not live[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node <<= 1
                node += not live[node]
        capacity = node - self.base
        bin_no = self.bins[capacity].pop()
        if not self.bins[capacity]:
            live[node] = 0
            node >>= 1
            while node and not (live[2 * node] or live[2 * node + 1]):
                live[node] = 0
                node >>= 1
        return capacity, bin_no


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Bins of item numbers; every item is in one bin and no bin holds more than ``length``. Ties go by item number."""
    tree, bins = CapacityTree(length), []
    order = np.argsort(-sizes, kind="stable").tolist()
    plain = sizes.tolist()
    for i in order:
        size = plain[i]
        if (found := tree.take(size)) is None:
            found = length, len(bins)
            bins.append([])
        bins[found[1]].append(i)
        tree.put(found[0] - size, found[1])
    return bins


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken vocabulary file, read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _pack(held: list[tuple], first: int, length: int, dtype) -> tuple[pa.RecordBatch, int]:
    """held: (doc_id, row_id, ids). Returns the rows and the next free pack number."""
    doc, row, offset, parts = [], [], [], []
    for d, r, ids in held:
        for start in range(0, max(1, len(ids)), length):
            doc.append(d)
            row.append(r)
            offset.append(start)
            parts.append(ids[start : start + length])
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    bins = best_fit_decreasing(sizes, length)
    flat = np.fromiter((i for b in bins for i in b), np.int64, len(parts))
    per = np.fromiter(map(len, bins), np.int64, len(bins))
    ends = np.cumsum(per)
    blobs, cu, resets = [], [], []
    for b in bins:
        blobs.append(np.concatenate([parts[i] for i in b]).astype(dtype).tobytes())
        at = np.concatenate([[0], np.cumsum(sizes[b])])
        cu.append(at.astype(np.int32))
        resets.append(np.unique(at[:-1][sizes[b] > 0]).astype(np.int32))
    lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, kind))
    ragged = lambda xs: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in xs])]), pa.int32()), pa.array(np.concatenate(xs) if xs else [], pa.int32()))
    order = flat.tolist()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(first, first + len(bins)), pa.int64()),
            pa.array(blobs, pa.binary()),
            pa.array([int(x[-1]) for x in cu], pa.int32()),
            ragged(cu),
            ragged(resets),
            lists([doc[i] for i in order], pa.int64()),
            lists([row[i] for i in order], pa.int64()),
            lists([offset[i] for i in order], pa.int64()),
        ],
        names=["pack_id", "ids", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "row_ids", "seg_offsets"],
    ), first + len(bins)


def pack_tokens(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """Packed rows: ids (little-endian uint16, or uint32 for vocabularies over 65,536), cu_seqlens (0 and the end of each
    segment), position_resets (where positions start again at 0), and for each segment its document, the row's number
    (so that repeated rows and null ids stay apart) and its offset in the document's ids.

    Null and empty texts take a segment of no ids, so every row of the input is in the output. An overlong document is
    cut every ``length`` ids. Ties in size go by row order. An empty table gives no rows. Other columns are not read.
    Ids are integers; those of another type are an error. Each run of ``window_tokens`` ids of a task's rows is packed by
    itself, so its last rows, and those of a small task, can be part filled.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} is no integer column")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((ranks, pattern))  # a vocabulary file: its size does not grow with the input
    dtype = "<u2" if max(ranks.values(), default=0) < 65_536 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table, pat = shared.value
        encoding = tiktoken.Encoding("own", pat_str=pat, mergeable_ranks=table, special_tokens={})
        part = TaskContext.get().partitionId() << 33
        held, tokens, number, row = [], 0, part, part
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoding.encode_to_numpy(t.as_py() or "", disallowed_special=()).astype(dtype)
                held.append((d, row, ids))
                row += 1
                tokens += len(ids)
                if tokens >= window_tokens or len(held) >= window_tokens // 8:
                    out, number = _pack(held, number, length, dtype)
                    yield out
                    held, tokens = [], 0
        if held:
            yield _pack(held, number, length, dtype)[0]

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(run), PACKED)


def write_packed(packed: DataFrame, path: str, *, length: int = LENGTH, wide: bool = False) -> None:
    """The matrices as files: rows padded with zeros to ``length`` ids, and position ids that restart at each segment.

    Takes ``pack_tokens``' rows, which hold no nulls; repeated rows are written repeatedly; an empty table gives files
    without rows; other columns are not written. ``path`` is overwritten.
    """
    dtype = "<u4" if wide else "<u2"

    def pad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, positions = [], []
            for blob, resets in zip(b.column("ids").to_pylist(), b.column("position_resets").to_pylist()):
                x = np.zeros(length, dtype)
                got = np.frombuffer(blob, dtype)
                x[: len(got)] = got
                starts = np.zeros(length, np.int64)
                starts[resets] = resets
                ids.append(x.tobytes())
                positions.append(np.where(np.arange(length) < len(got), np.arange(length) - np.maximum.accumulate(starts), 0).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("pack_id", "n_tokens", "cu_seqlens")), pa.array(ids, pa.binary()), pa.array(positions, pa.binary())], names=["pack_id", "n_tokens", "cu_seqlens", "ids", "position_ids"])

    packed.mapInArrow(lean(pad), "pack_id long, n_tokens int, cu_seqlens array<int>, ids binary, position_ids binary").write.mode("overwrite").parquet(path)


def query(spark: SparkSession, sf_dir: str, vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken") -> DataFrame:
    import public_tokenizers

    return pack_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), load_ranks(vocabulary), public_tokenizers.PATTERN)
