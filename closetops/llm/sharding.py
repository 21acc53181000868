"""Contiguous shards of equal bytes.

The rows are range-partitioned by id; the totals of the partitions are turned
into prefix sums (one row per partition), and a running sum inside each
partition gives every row its place in the global sequence of bytes.  The
sequence is cut at equal targets.  The range-partitioned rows are written
once with their partition's number, so that totals and places are taken from
the same cut even when an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import stage

#: Bytes that a row counts besides its text.
OVERHEAD = 16
SHARDS = 40


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
          overhead: int = OVERHEAD, rows: bool = False) -> DataFrame:
    """One row per input row: id, size (UTF-8 bytes plus ``overhead``), crc (of the text), shard
    (0 to shards - 1), slot (gapless from 0 in each shard); with ``rows`` also the input row as
    struct ``row``.

    Shards are runs of the rows in order of id (null first, ties by checksum and size).  A row
    belongs to the shard in which the middle of its bytes lies, so a shard's bytes differ from
    an equal part by less than the largest rows at its ends.  Null texts are empty; repeated
    rows are rows of their own and may be dealt to neighbouring shards; an empty table gives
    no rows; with fewer rows than shards, or a row larger than a part, some shards are empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("crc"), F.monotonically_increasing_id().alias("tie"),
                        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []))
    if not rows:
        sized = stage(sized)  # the range partitioning reads its input twice
    order = ["id", "crc", "size", "tie"]
    placed = stage(sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_ahead"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_ahead"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, -1)

    def dealt(table: DataFrame) -> DataFrame:
        middle = 2 * (F.col("bytes_ahead") + F.coalesce(F.sum("size").over(running), F.lit(0))) + F.col("size")
        return (table.join(offsets, "part")
                .withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * F.col("total")))).cast("int"))
                .withColumn("place", F.col("rows_ahead") + F.row_number().over(inside) - 1))

    firsts = dealt(placed.select("part", *order)).groupBy("shard").agg(F.min("place").alias("first"))
    return (dealt(placed).join(firsts, "shard")
            .select("id", "size", "crc", "shard", (F.col("place") - F.col("first")).alias("slot"),
                    *(["row"] if rows else [])))


def sharded(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` with ``shard`` and ``slot`` (which replace columns of these names)."""
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    return shard(docs, rows=True, **how).select(*[F.col(f"row.`{c}`") for c in own], "shard", "slot")


def op5(docs: DataFrame) -> DataFrame:
    return shard(docs).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
