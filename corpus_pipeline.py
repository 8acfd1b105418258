"""The training-data pipeline: stages that each take the documents their predecessor kept.

Every stage takes null ids and texts, empty and very long texts, repeated rows, extra columns of any name and empty
tables. All but the last return the columns of their documents, and no rows for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm import decontaminate, piece_sampling, quality_gam, simhash_ball, toxicity_pu
from loamworks.llm.lattice import load_vocabulary
from loamworks.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go. It is fitted on the labelled rows of the whole corpus. Null texts are
    judged as empty ones; equal texts stay or go together."""
    return quality_gam.keep(docs, quality_gam.trained_on(spark, sf_dir))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It is fitted on the labelled rows of the whole corpus. Null texts are
    judged as empty ones; equal texts stay or go together."""
    return toxicity_pu.keep(docs, toxicity_pu.trained_on(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id, null ids last, any one of
    repeated rows. Texts without words (null ones too) are copies of each other."""
    return simhash_ball.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is, nearly so, or with other numbers, names and units, go.
    Null and empty texts hold none."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), near_verbatim=True)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with a sampled segmentation's ids in place of the text, which the ids restore. A null text has
    null ids (and ``n_ids``), an empty one has none."""
    encoded = piece_sampling.encode_sampled(docs, load_vocabulary(piece_sampling.VOCABULARY))
    return encoded.drop("text").withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Learned models and sampled segmentations are beyond SQL; ``tests/llm/test_stages.py`` holds each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
