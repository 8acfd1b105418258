"""Quality by a generalised additive model with pairwise interactions.

Each feature is cut into quantile bins. Shallow trees, boosted cyclically over the features, add up to one lookup table
a feature; then trees over the most useful pairs, boosted the same way, to one table a pair. A document's score is the
logistic of the sum of the cells that its features fall into. The model is fitted on the driver, on at most ``SAMPLE``
labelled rows, whose features are computed on the executors; every text is scored whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm.shared import crc_mod, lean

#: Labelled rows that the model is fitted on at most: those whose ids' hashes are least.
SAMPLE = 20_000
THRESHOLD = 0.3
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
RATE = 0.1
RIDGE = 5.0

FEATURES = (
    "log_words", "log_chars", "word_length", "word_length_spread", "longest_word", "short_words", "distinct_words",
    "repeated_triples", "top_word", "log_lines", "line_length", "repeated_lines", "upper", "digits", "marks", "symbols",
    "commas", "stops", "bars", "exclamations", "high_bytes", "control", "shouted_words", "marked_words",
)
_UPPER, _LOWER, _DIGIT = np.arange(65, 91), np.arange(97, 123), np.arange(48, 58)
_SYMBOL = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)
_MARK = np.frombuffer(b"!\"'(),-.:;?", np.uint8)
_CONTROL = np.array([*range(9), 11, 12, *range(14, 32), 127])
_DROP = bytes(_SYMBOL) + b"!"


def features(text: str | None) -> list[float]:
    """The numbers in ``FEATURES`` for a whole text; null counts as empty."""
    raw = (text or "").encode()
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(1, len(raw))
    words = raw.split()
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = max(1, n - 2)
    letters = max(1, int(hist[_UPPER].sum() + hist[_LOWER].sum()))
    return [
        math.log1p(len(words)),
        math.log1p(len(raw)),
        float(lengths.mean()),
        float(lengths.std()),
        math.log1p(float(lengths.max())),
        float((lengths <= 2).sum()) / n,
        len(counts) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if n > 2 else 0.0,
        max(counts.values(), default=0) / n,
        math.log1p(len(lines)),
        math.log1p(len(raw) / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
        float(hist[_UPPER].sum()) / letters,
        float(hist[_DIGIT].sum()) / size,
        float(hist[_MARK].sum()) / size,
        float(hist[_SYMBOL].sum()) / size,
        float(hist[44]) / n,
        float(hist[46]) / n,
        float(hist[124]) / n,
        float(hist[33]) / n,
        float(hist[128:].sum()) / size,
        float(hist[_CONTROL].sum()) / size,
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n,
        sum(c for w, c in counts.items() if w[-1] in _DROP) / n,
    ]


@dataclass
class Model:
    edges: list[np.ndarray]
    pair_edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (edge, table) in enumerate(zip(self.edges, self.tables)):
            z += table[np.searchsorted(edge, x[:, f], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            z += table[np.searchsorted(self.pair_edges[i], x[:, i], side="right"), np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, bins in the left part); gain 0 if no cut helps."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Each bin's step in a tree of at most ``leaves`` leaves over the bins' gradients and curvatures."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, cut, k = max((*_best_cut(g[a:b], h[a:b]), i) for i, (a, b) in enumerate(parts))
        if gain <= 1e-9:
            break
        a, b = parts[k]
        parts[k : k + 1] = [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _best_cross(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """(gain, row cut, column cut) of the best cross of two cuts over a grid."""
    G, H = np.zeros((len(g) + 1, g.shape[1] + 1)), np.zeros((len(g) + 1, g.shape[1] + 1))
    G[1:, 1:], H[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def quarters(S: np.ndarray) -> list[np.ndarray]:
        a, r, c, t = S[1:-1, 1:-1], S[1:-1, -1:], S[-1:, 1:-1], S[-1, -1]
        return [a, r - a, c - a, t - r - c + a]

    gain = sum(_gain(x, y) for x, y in zip(quarters(G), quarters(H)))
    if not gain.size:
        return 0.0, 0, 0
    at = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[at]), int(at[0]) + 1, int(at[1]) + 1


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """x: rows by features; y: 0 or 1. With rows of one label, or none, every score is the (smoothed) label's share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    cut = lambda n: [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n + 1)[1:-1])) if len(x) else np.empty(0) for f in range(x.shape[1])]
    edges, pair_edges = cut(BINS), cut(PAIR_BINS)
    model = Model(edges, pair_edges, math.log(share / (1 - share)), [np.zeros(len(e) + 1) for e in edges], [], [])
    if len(set(y.tolist())) < 2:
        return model
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    z = np.full(len(x), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * shallow_tree(np.bincount(at[f], g, len(table)), np.bincount(at[f], h, len(table)))
            table += step
            z += step[at[f]]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(pair_edges)]
    wide = [len(e) + 1 for e in pair_edges]
    grid = lambda i, j, v: np.bincount(coarse[i] * wide[j] + coarse[j], v, wide[i] * wide[j]).reshape(wide[i], wide[j])
    g, h = slopes()
    ranked = sorted(((_best_cross(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(len(edges)) for j in range(i)), reverse=True)
    for gain, i, j in ranked[:PAIRS]:
        if gain > 0:
            model.pairs.append((i, j))
            model.pair_tables.append(np.zeros((wide[i], wide[j])))
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            gg, hh = grid(i, j, g), grid(i, j, h)
            gain, r, c = _best_cross(gg, hh)
            if gain <= 1e-9:
                continue
            step = np.zeros_like(table)
            for rows in (slice(0, r), slice(r, None)):
                for cols in (slice(0, c), slice(c, None)):
                    step[rows, cols] = RATE * gg[rows, cols].sum() / (hh[rows, cols].sum() + RIDGE)
            table += step
            z += step[coarse[i], coarse[j]]
    return model


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(order, y, text) -> (order, y, x)"""
    for b in batches:
        flat = np.array([features(t.as_py()) for t in b.column(2)], float).reshape(-1)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * len(FEATURES), pa.int32()), pa.array(flat))], names=["at", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, usable: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """``usable``, over the id column, picks the labels that may be learned from; null labels and ids are skipped."""
    known = labels.where(usable & labels[label_col].isNotNull() & labels[id_col].isNotNull())
    ids = known.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("y")).orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(ids), "id")  # at most ``sample`` rows
    rows = texts.select(F.xxhash64("id").alias("at"), "y", "text").mapInArrow(lean(_rows), "at long, y int, x array<double>").orderBy("at", "y", "x").limit(sample).toArrow()
    x = rows["x"].combine_chunks()
    x = x.flatten().to_numpy() if rows.num_rows else np.empty(0)
    return fit(np.reshape(x, (-1, len(FEATURES))), rows["y"].to_numpy().astype(float))


def _scored(texts: pa.ChunkedArray, model: Model) -> np.ndarray:
    x = np.array([features(t.as_py()) for t in texts], float).reshape(-1, len(FEATURES))
    return model.score(x)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) for every row; null texts score as empty ones. An empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scored(b.column(1), shared.value))], names=["doc_id", "score"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col]).mapInArrow(lean(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def keep(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score is ``threshold`` or more. Null texts score as empty ones; equal texts
    score alike, so repeated rows stay or go together; an empty table stays empty. Other columns are carried as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scored(b.column(at), shared.value) >= threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def trained_on(spark: SparkSession, sf_dir: str) -> Model:
    return train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), crc_mod("doc_id", 5) != 0)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), trained_on(spark, sf_dir))
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
