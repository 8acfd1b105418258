"""Global positions and running sums without a window over the whole table.

Rows are dealt into ranges of the order, their slim keys are checkpointed with the range's number, each range's totals
give its offset, and a window within the range gives the rest. No task sees more than its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares; one of our own only where the session names none and all runs on one machine.
    A cluster without a named folder is an error, as each executor would write to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir names no folder that the cluster shares")
    return named or LOCAL_CHECKPOINTS


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the folder that the cluster shares."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def random_key(seed: int, id_col: str) -> Column:
    """A reproducible random order: any engine with SHA-256 has the same."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def ranked(df: DataFrame, *order: Column | str, weight: Column | None = None) -> DataFrame:
    """``position`` (from 0) in the order given, ties in any order; with ``weight``, ``ahead``: its sum over all rows before."""
    keyed = df.withColumns({f"__o{i}": (F.col(o) if isinstance(o, str) else o) for i, o in enumerate(order)} | {"__w": (F.lit(0) if weight is None else weight).cast("long"), "__salt": F.monotonically_increasing_id()})
    keys = [f"__o{i}" for i in range(len(order))] + ["__salt"]
    dealt = checkpointed(keyed.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    totals = dealt.groupBy("__part").agg(F.count("*").alias("n"), F.sum("__w").alias("w"))
    offsets = totals.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__n"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("__ahead"))
    inside = Window.partitionBy("__part").orderBy(*keys)
    out = dealt.join(F.broadcast(offsets), "__part").withColumn("position", F.col("__n") + F.row_number().over(inside) - 1)
    if weight is not None:
        out = out.withColumn("ahead", F.col("__ahead") + F.sum("__w").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__w"))
    return out.drop(*keys, "__w", "__part", "__n", "__ahead")


def table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(rows, ddl)
