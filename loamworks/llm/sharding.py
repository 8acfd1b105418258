"""Contiguous shards of near equal bytes, from prefix sums over partitions. DataFrame operations only.

Rows are reduced to (id, size, crc), dealt into ranges by (id, crc, size) and written; each partition's total makes a
small table whose running sum gives the partition's offset, and a window inside the partition gives each row's own.
Shard k holds the rows whose middle byte lies in the k-th of equal parts. Only slim rows are shuffled, no text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamworks.llm.shared import written

ROW_OVERHEAD = 16


def shard_by_bytes(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", overhead: int = ROW_OVERHEAD) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row, in the order of (id, crc, size), null ids first.

    A null text has no bytes: size ``overhead``, crc 0, as an empty text. Rows that tie in all three are equal in the
    result, so their order does not matter; a tie-breaking salt spreads them over partitions. A text longer than a
    shard's part leaves some shards empty. An empty table gives no rows.
    """
    slim = docs.select(
        docs[id_col].alias("doc_id"),
        (F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long") + F.lit(overhead)).alias("size"),
        F.coalesce(F.crc32(docs[text_col].cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("salt"),
    )
    slim = written(slim, "sizes")  # range bounds and dealing both read it: the texts are read once
    # The partition number is stored with the row: whatever is computed again later, offsets and rows agree.
    dealt = written(slim.repartitionByRange("doc_id", "text_crc32", "size", "salt").withColumn("part", F.spark_partition_id()), "shards")
    # One row a partition: a window over them all is as small as the plan.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_offset"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_offset"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy("doc_id", "text_crc32", "size", "salt")
    placed = (
        dealt.withColumn("row", F.row_number().over(inside) - 1)
        .withColumn("ahead", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(F.broadcast(offsets), "part")  # one row a partition
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("row_offset") + F.col("row")).alias("position"),
            F.expr(f"cast(least({shards - 1}, ((2 * (byte_offset + ahead) + size) * {shards}) div (2 * all_bytes)) as int)").alias("shard"),
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot"))


def query(spark: SparkSession, sf_dir: str, shards: int = 40) -> DataFrame:
    out = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: crc32 by its bit rule, as DuckDB has no such function; all else are plain window functions.
ORACLE_SQL = """
with steps as (
  select d.doc_id, strlen(coalesce(d.text, '')) + 16 as size,
         list_transform(string_split(regexp_replace(hex(encode(coalesce(d.text, ''))), '(..)', '\\1 ', 'g'), ' ')[:-2], lambda h: ('0x' || h)::bigint) as bytes
  from documents d
), crcs as (
  select doc_id, size::bigint as size,
         xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, z: xor(x >> 1, (x & 1) * 3988292384::bigint)))) as text_crc32
  from steps
), placed as (
  select *, row_number() over o - 1 as position, sum(size) over (o rows unbounded preceding) - size as ahead, sum(size) over () as all_bytes
  from crcs window o as (order by doc_id nulls first, text_crc32, size)
), cut as (
  select doc_id, size, text_crc32, position, least(39, ((2 * ahead + size) * 40) // (2 * all_bytes))::int as shard from placed
)
select doc_id, size, text_crc32, 'bytes' as law, shard, (position - min(position) over (partition by shard))::bigint as slot, null::int as grown_shard
from cut
"""
