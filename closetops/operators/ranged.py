"""Row numbers over hot keys, cut where the data is.

The rows are range-partitioned by (key, order): Spark samples the sort key, so
the cuts are quantiles of the data and a key with most of the rows is spread
over as many partitions as its rows fill, however they lie in time.  Rows are
numbered inside (partition, key); a key that began in an earlier partition goes
on from its count there.  Only the first key of a partition can have begun
earlier, so the table of counts ahead has at most one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import stage
from .seqlog import null_safe_keys

_PART, _AHEAD = "_rp_part", "_rp_ahead"


def range_pieces(df: DataFrame, keys: list[str], order: list) -> tuple[DataFrame, list[str]]:
    """``df`` range-partitioned by (keys, order) and written once, with its partition's number, and
    the names of the null-safe key columns added."""
    x, nk = null_safe_keys(df, keys, prefix="_rp_k")
    return stage(x.repartitionByRange(*nk, *order).withColumn(_PART, F.spark_partition_id())), nk


def counts_ahead(pieces: DataFrame, nk: list[str]) -> DataFrame:
    """(key, partition, rows of the key in earlier partitions), only where there are such rows."""
    counts = pieces.groupBy(*nk, _PART).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*nk).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*nk, _PART, F.sum("_n").over(before).alias(_AHEAD)).where(F.col(_AHEAD).isNotNull())


def row_number_ranged(df: DataFrame, keys: list[str], order: list, out: str) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` with no window larger than a partition.

    ``order`` must be unique within a key for a deterministic numbering.  Null keys are one group;
    an empty table gives no rows.
    """
    pieces, nk = range_pieces(df, keys, order)
    inside = F.row_number().over(Window.partitionBy(_PART, *nk).orderBy(*order))
    numbered = pieces.withColumn("_rp_in", inside)
    j = numbered.join(counts_ahead(pieces, nk), [*nk, _PART], "left")
    return j.select(*[F.col(c) for c in df.columns], (F.col("_rp_in") + F.coalesce(_AHEAD, F.lit(0))).alias(out))


def running_sum_ranged(df: DataFrame, keys: list[str], order: list, value: str, out: str, total: str | None = None) -> DataFrame:
    """Running sum of ``value`` per key in ``order`` (rows equal in order: each after the other), and
    the key's whole sum as ``total``; no window is larger than a partition and no key held by one task."""
    pieces, nk = range_pieces(df, keys, order)
    inside = Window.partitionBy(_PART, *nk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = pieces.groupBy(*nk, _PART).agg(F.sum(value).alias("_n"))
    by_part = Window.partitionBy(*nk).orderBy(_PART)
    ahead = sums.select(*nk, _PART, F.sum("_n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)).alias(_AHEAD),
                        F.sum("_n").over(Window.partitionBy(*nk)).alias("_all"))
    j = pieces.withColumn("_rp_in", F.sum(value).over(inside)).join(ahead, [*nk, _PART])
    return j.select(*[F.col(c) for c in df.columns], (F.col("_rp_in") + F.coalesce(_AHEAD, F.lit(0))).alias(out),
                    *([F.col("_all").alias(total)] if total else []))
