"""Sampled SentencePiece segmentations that are reproducible and lossless.

Forward filtering sums all segmentations of each distinct unit once; backward sampling draws the last piece, then the
one before it, and so on, for all occurrences in lockstep. Each draw's uniform number is a hash of the seed, the row's
key, the unit's place in the text and the step, so neither batches nor partitions nor retries change a result.

Texts are taken some hundred thousand characters at a time, cut between units, and a long unit segment by segment: from
the state before its last segment the draws run back through it, then through the one before. So a task's memory grows
with the longest text's ids only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm import lattice as lattice_of
from loamworks.llm.lattice import Lattice, Vocabulary, load_vocabulary
from loamworks.llm.shared import lean

#: No piece holds a line break, and a space only at its start.
UNIT = re.compile(r"\n| +[^ \n]*|[^ \n]+")
#: Rows that are answered together at most, and the bytes of their texts, but for a row that is larger.
BATCH_ROWS, BATCH_BYTES = 1_000, 1_000_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's output function."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Sampler:
    def __init__(self, vocabulary: Vocabulary, power: float, seed: int) -> None:
        self.lattice, self.power, self.seed = Lattice(vocabulary), power, np.array([seed], np.uint64)

    def sample(self, units: list[str], key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each occurrence of a unit, with its row's key and its place in the row: (ids of all, how many each has)."""
        index: dict[str, int] = {}
        which = np.fromiter([index.setdefault(u, len(index)) for u in units], np.int64, len(units))
        lay, piece, _, cdf = self.lattice.forward(list(index), self.power, chances=True)
        start = lay.level_start
        rng = mix(key ^ mix(place.astype(np.uint64) ^ mix(self.seed)))
        rank, p = lay.rank[which], lay.size[which] - 1
        live = np.arange(len(units))
        per = np.zeros(len(units), np.int64)
        drawn = []
        while len(live):
            here = start[p] + rank
            u = (mix(rng + np.uint64(len(drawn))) >> np.uint64(40)).astype(np.float32) * np.float32(2**-24)
            step = (cdf[here] <= u[:, None]).sum(1)
            p = p - step
            begin = start[p] + rank
            ids = piece[step, begin]
            width = np.ones(len(live), np.int64)
            spelt = np.flatnonzero(ids == -2)
            raw = [chr(c).encode() for c in lay.cps[begin[spelt]].tolist()]
            width[spelt] = [len(r) for r in raw]
            per[live] += width
            drawn.append((live, ids, width, spelt, raw))
            more = p > 0
            live, rank, p, rng = live[more], rank[more], p[more] - 1, rng[more]
        tail = np.cumsum(per)
        out = np.empty(int(tail[-1]) if len(tail) else 0, np.int32)
        for who, ids, width, spelt, raw in drawn:  # the last pieces come first
            tail[who] -= width
            to = tail[who]
            out[to] = ids
            for t, r in zip(to[spelt].tolist(), raw):
                out[t : t + len(r)] = self.lattice.vocabulary.byte_ids[list(r)]
        return out, per

    def sample_long(self, unit: str, key: np.uint64, place: int) -> np.ndarray:
        """The ids of one unit of any length, drawn backward segment by segment."""
        rng = mix(np.array([key], np.uint64) ^ mix(np.array([place], np.uint64) ^ mix(self.seed)))
        states = list(self.lattice.states(unit, self.power))
        spelt, drawn, at, left = self.lattice.vocabulary.byte_ids, [], len(unit), []
        steps = 0
        for start in range((len(unit) - 1) // lattice_of.SEGMENT * lattice_of.SEGMENT, -1, -lattice_of.SEGMENT):
            ids, cdf = self.lattice.segment(unit, start, states[start // lattice_of.SEGMENT], self.power)
            while at > start:
                if not left:
                    u = (mix(rng + np.arange(steps, steps + 4096, dtype=np.uint64)) >> np.uint64(40)).astype(np.float32) * np.float32(2**-24)
                    left = u[::-1].tolist()
                    steps += len(left)
                end = at - 1 - start
                step = int(cdf[end].searchsorted(left.pop(), "right"))
                got = int(ids[step, end])
                if got >= 0:
                    drawn.append(got)
                else:
                    drawn.extend(spelt[list(unit[at - 1].encode()[::-1])].tolist())
                at -= step + 1
        return np.array(drawn[::-1], np.int32)

    def encode(self, texts: list[str | None], keys: np.ndarray) -> list[np.ndarray]:
        """Ids of each text; a space goes before it, as the vocabulary's words start with one."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        units: list[str] = []
        spans: list[tuple[int, int, int]] = []
        chars = 0

        def flush() -> None:
            if not units:
                return
            count = np.array([n for _, _, n in spans])
            key = np.repeat(keys[[i for i, _, _ in spans]], count)
            place = np.concatenate([np.arange(start, start + n) for _, start, n in spans])
            ids, per = self.sample(units, key, place)
            cuts = np.cumsum(np.add.reduceat(per, np.cumsum(count) - count))[:-1]
            for (i, _, _), part in zip(spans, np.split(ids, cuts)):
                out[i].append(part)
            units.clear()
            spans.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            place = 0
            for part, size in parts(f" {text}"):
                if chars + size > lattice_of.CHUNK_CHARS:
                    flush()
                    chars = 0
                if len(part) == 1 and size > lattice_of.LONG_UNIT:
                    flush()
                    out[i].append(self.sample_long(part[0], keys[i], place))
                else:
                    units.extend(part)
                    spans.append((i, place, len(part)))
                    chars += size
                place += len(part)
        flush()
        return [np.concatenate(x) if x else np.empty(0, np.int32) for x in out]


def parts(text: str) -> Iterator[tuple[list[str], int]]:
    """The text's units, some hundred thousand characters at a time, and how many; a long unit is alone."""
    chunk, start = lattice_of.CHUNK_CHARS, 0
    while start < len(text):
        end = len(text)
        if end - start > chunk:  # back to where the last unit starts, or forward to where the only one ends
            end = max(text.rfind(" ", start, start + chunk), text.rfind("\n", start, start + chunk))
            while end > start and text[end] == " " == text[end - 1]:
                end -= 1
            if end <= start:
                end = UNIT.match(text, start).end()
        found = UNIT.findall(text, start, end)
        cuts = [i for i, u in enumerate(found) if len(u) > lattice_of.LONG_UNIT] if end - start > lattice_of.LONG_UNIT else []
        for a, b in pairwise(sorted({0, len(found), *cuts, *(i + 1 for i in cuts)})):
            yield found[a:b], sum(map(len, found[a:b]))
        start = end


class Decoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        raw = [(p or "").encode() for p in vocabulary.pieces]
        for b, i in enumerate(vocabulary.byte_ids):
            raw[i] = bytes([b])
        self.raw = np.array(raw, object)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.raw[ids])[1:].decode() if len(ids) else ""


def encode_sampled(docs: DataFrame, vocabulary: Vocabulary, *, key_col: str = "doc_id", text_col: str = "text", out_col: str = "ids", decoded_col: str | None = None, power: float = 1.0, seed: int = 42) -> DataFrame:
    """The table with ``out_col``: array<int>, the ids of one segmentation drawn with probability proportional to the
    product of its pieces' weights raised to ``power``; and with ``decoded_col``, if named: what the ids decode to.

    A null text has null ids and decodes to null, an empty one has none and decodes to an empty one. Texts and words of
    any length are taken whole. Rows with the same key and text have the same ids; a null key counts as empty. Columns
    of the table by the new names are replaced. An empty table stays empty.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)  # a vocabulary file: its size does not grow with the input
    made = [out_col, *([decoded_col] if decoded_col else [])]
    columns = [c for c in docs.columns if c not in made]
    # the text goes in under a name of its own: it may be one of the columns that are replaced
    source = docs.select(*[docs[c] for c in columns], docs[text_col].alias("__text"), F.xxhash64(F.coalesce(docs[key_col].cast("string"), F.lit(""))).alias("__key"))
    if text_col in columns:
        source = source.drop("__text")
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns] + [f"`{out_col}` array<int>"] + [f"`{decoded_col}` string"] * bool(decoded_col)
    text_at, many = source.columns.index(text_col if text_col in columns else "__text"), len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, decoder = Sampler(shared.value, power, seed), Decoder(shared.value)

        def answered(rows: pa.RecordBatch, texts: list[str | None], ids: list[np.ndarray]) -> pa.RecordBatch:
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            none = np.array([t is None for t in texts])
            new = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()), mask=pa.array(none))]
            if decoded_col:
                new.append(pa.array([None if t is None else decoder.decode(x) for t, x in zip(texts, ids)], pa.string()))
            return pa.RecordBatch.from_arrays([*rows.columns[:many], *new], names=[*columns, *made])

        for b in batches:
            sizes = pa.compute.binary_length(b.column(text_at)).fill_null(0).to_numpy(zero_copy_only=False)
            keys = b.column(b.num_columns - 1).to_numpy().view(np.uint64)
            start = 0
            while start < b.num_rows:
                n = max(1, int(np.searchsorted(sizes[start : start + BATCH_ROWS].cumsum(), BATCH_BYTES, "right")))
                rows = b.slice(start, n)
                texts = rows.column(text_at).to_pylist()
                yield answered(rows, texts, sampler.encode(texts, keys[start : start + n]))
                start += n

    return source.mapInArrow(lean(run), ", ".join(kinds))


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The table with ``out_col``: the text that ``ids_col`` stands for, byte for byte what was encoded. Null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    columns = [c for c in encoded.columns if c != out_col]
    schema = ", ".join([*(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in columns), f"`{out_col}` string"])
    at = columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for b in batches:
            texts = [None if not x.is_valid else decoder.decode(x.values.to_numpy()) for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*columns, out_col])

    return encoded.select(*[encoded[c] for c in columns]).mapInArrow(lean(run), schema)


VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def query(spark: SparkSession, sf_dir: str, path: str = VOCABULARY) -> DataFrame:
    """doc_id, ids, their number, and the crc32 of the text and of what the ids decode to (null for a null text)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode_sampled(docs, load_vocabulary(path), decoded_col="decoded")
    crc = lambda c: F.crc32(F.col(c).cast("binary"))
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), crc("text").alias("text_crc32"), crc("decoded").alias("decoded_crc32"))
