"""What several operators share: splits by id, whole-text bytes, and tables that cut lineage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def crc_mod(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares. A folder of our own is used only where the session names none and all runs on
    one machine; a cluster without a named folder is an error, as each executor would write to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir names no folder that the cluster shares")
    return named or LOCAL_CHECKPOINTS


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later plans read it instead of computing it again.

    A lost executor costs nothing that was written. The tables stay until ``forget`` or until the folder's
    own expiry removes them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/loamworks-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the tables that ``written`` made for ``df``."""
    jvm = df.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/loamworks-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only ``columns``, whatever else the table holds. An ambiguous or missing name is an error."""
    return df.select(*[df[c] for c in columns])


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow or mapInPandas, giving freed memory back at the task's end: workers live on between tasks."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return wrapped
