"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled ones train a sparse logistic classifier over the words that a text holds. The
risk of the negative class is estimated as that of the unlabelled texts less the class prior's share of that of the
toxic ones; where this falls below zero, which only overfitting can bring about, the step goes the other way. The
samples are bounded; words are counted on the executors and only the chosen ones' places reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm.shared import crc_mod, lean

#: Toxic and unlabelled rows that the model is fitted on at most: those whose ids' hashes are least.
POSITIVES = 5_000
UNLABELLED = 15_000
#: Words that the classifier may use at most, and toxic texts that a word must be in.
WORDS = 3_000
LEAST_TEXTS = 3
#: Times the log of the number of words that a word's likelihood ratio must reach. This, the steps and the sparsity were
#: chosen on training rows alone: fitted where crc32(doc_id) mod 3 is 0, compared where it is 2.
SCREEN = 1.0
THRESHOLD = 0.7
STEPS = 400
RATE = 0.1
SPARSITY = 2e-5
_WORD = re.compile(r"\w+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class Model:
    weight: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        found = words(text) & self.weight.keys()
        z = self.bias + sum(self.weight[w] for w in sorted(found))
        return float(1 / (1 + np.exp(-min(40.0, max(-40.0, z)))))


def risk(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, float]:
    """(of the toxic as toxic, of the toxic as clean, of the unlabelled as clean), each a mean of logistic losses."""
    loss = lambda v: np.logaddexp(0, -v)
    return float(loss(z[positive]).mean()), float(loss(-z[positive]).mean()), float(loss(-z[~positive]).mean())


def fit(row: np.ndarray, col: np.ndarray, positive: np.ndarray, width: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias from the places (row, col) of the ones of a 0/1 matrix. Adam steps, with soft thresholds."""
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    moment, square = np.zeros(width + 1), np.zeros(width + 1)
    n_p, n_u = positive.sum(), (~positive).sum()
    for t in range(1, STEPS + 1):
        z = b + np.bincount(row, w[col], len(positive))
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        _, as_clean, unlabelled = risk(z, positive, prior)
        clean = np.where(positive, -prior * s / n_p, s / n_u)  # of the estimated clean risk
        if unlabelled - prior * as_clean >= 0:
            slope = clean + np.where(positive, prior * (s - 1) / n_p, 0)
        else:
            slope = -clean
        g = np.append(np.bincount(col, slope[row], width), slope.sum())
        moment, square = 0.9 * moment + 0.1 * g, 0.999 * square + 0.001 * g * g
        step = RATE / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
        b -= float(step[-1] * moment[-1] / (1 - 0.9**t))
        w = w - step[:-1] * moment[:-1] / (1 - 0.9**t)
        w = np.sign(w) * np.maximum(0, np.abs(w) - np.minimum(step[:-1], 100.0) * SPARSITY)
    return w, b


def _doc_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([sorted(words(t.as_py())) for t in b.column(2)], pa.list_(pa.string()))], names=["at", "toxic", "words"])


def train(docs: DataFrame, labels: DataFrame, usable: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """``usable``, over the id column, picks the rows that may be learned from. The class prior is the toxic share of
    their labels. Without toxic or without unlabelled texts, every score is that share (0 with no labels)."""
    known = labels.where(usable & labels[label_col].isNotNull() & labels[id_col].isNotNull())
    prior = known.agg(F.avg(labels[label_col].cast("double"))).first()[0] or 0.0
    prior = min(0.95, max(0.001, prior))
    first = lambda df, n: df.orderBy(F.xxhash64("id"), "id").limit(n)
    toxic = first(known.where(labels[label_col] == 1).select(labels[id_col].alias("id")).distinct(), positives).withColumn("toxic", F.lit(True))
    plain = first(docs.where(usable & docs[id_col].isNotNull()).select(docs[id_col].alias("id")), unlabelled).distinct().withColumn("toxic", F.lit(False))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    # At most ``positives`` and ``unlabelled`` ids are broadcast.
    picked = texts.join(F.broadcast(toxic.unionByName(plain)), "id").select(F.xxhash64("id", "text").alias("at"), "toxic", "text")
    held = picked.mapInArrow(lean(_doc_words), "at long, toxic boolean, words array<string>").persist()
    try:
        n_p, n_u = held.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
        if not n_p or not n_u:
            return Model({}, float(np.log(prior / (1 - prior))))
        counts = held.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.count_if("toxic").alias("p"), F.count_if(~F.col("toxic")).alias("u")).where(F.col("p") >= LEAST_TEXTS)
        # Twice the log likelihood ratio of two rates against one, of the order of what the best of so many equal words reaches.
        part = lambda k, n, rate: F.when(k > 0, k * F.log(k / (n * rate))).otherwise(0) + F.when(k < n, (n - k) * F.log((n - k) / (n * (1 - rate)))).otherwise(0)
        share = (F.col("p") + F.col("u") + 1e-9) / F.lit(n_p + n_u + 1e-6)
        counts = counts.withColumn("ratio", 2 * (part(F.col("p"), F.lit(n_p), share) + part(F.col("u"), F.lit(n_u), share))).persist()
        least = SCREEN * np.log(max(2, counts.count()))
        chosen = sorted(r["word"] for r in counts.where(F.col("ratio") >= float(least)).orderBy(F.desc("ratio"), "word").limit(WORDS).select("word").collect())
        counts.unpersist()
        vocabulary = held.sparkSession.createDataFrame(list(zip(chosen, range(len(chosen)))), "word string, place int")
        known_words = held.select("at", "toxic", F.explode_outer("words").alias("word")).join(F.broadcast(vocabulary), "word", "left")
        rows = known_words.groupBy("at", "toxic").agg(F.sort_array(F.collect_set("place")).alias("places")).orderBy("at", "toxic").limit(positives + unlabelled).toArrow()
    finally:
        held.unpersist()
    per = np.array([len(x) for x in rows["places"].to_pylist()])
    col = rows["places"].combine_chunks().flatten().to_numpy()
    w, b = fit(np.repeat(np.arange(len(per)), per), col, rows["toxic"].to_numpy(zero_copy_only=False).astype(bool), len(chosen), prior)
    return Model({c: float(x) for c, x in zip(chosen, w) if x}, b)


def _scored(texts, model: Model) -> np.ndarray:
    return np.array([model.score(t.as_py()) for t in texts], float)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) for every row; null texts score as empty ones. An empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scored(b.column(1), shared.value))], names=["doc_id", "score"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col]).mapInArrow(lean(run), f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def keep(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score is below ``threshold``. Null texts score as empty ones; equal texts
    score alike, so repeated rows stay or go together; an empty table stays empty. Other columns are carried as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scored(b.column(at), shared.value) < threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def trained_on(spark: SparkSession, sf_dir: str) -> Model:
    return train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), crc_mod("doc_id", 3) != 1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), trained_on(spark, sf_dir))
    return out.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
