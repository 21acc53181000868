"""Publishing report results (the analyses' ``CREATE TABLE .. AS`` / ``CREATE OR REPLACE TABLE``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def publish(df: DataFrame, path: str | None = None, table: str | None = None,
            partition_by: list[str] | None = None, mode: str = "overwrite", fmt: str = "parquet",
            replace: str = "all") -> None:
    """Write a report to a path or a catalog table, replacing the previous version.

    ``partition_by`` (e.g. a fiscal month column) lets later reads prune whole
    folders.  Exactly one of ``path`` / ``table`` is required.  A path is
    overwritten by writing beside it and swapping folders once all is written, so
    a failed job leaves the old version, and a report may read the version it
    replaces.  ``replace="partitions"`` replaces only the partitions that ``df``
    holds rows of (dynamic partition overwrite).
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    if replace not in ("all", "partitions") or (replace == "partitions" and not partition_by):
        raise ValueError("replace is 'all', or 'partitions' with partition_by")
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if replace == "partitions":
        w = w.option("partitionOverwriteMode", "dynamic")
    if table is not None:
        w.mode(mode).saveAsTable(table)
    elif mode != "overwrite" or replace == "partitions":
        w.mode(mode).save(path)
    else:
        beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
        w.mode("error").save(beside)
        _swap(df.sparkSession, beside, path.rstrip("/"))


def _swap(spark, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path`` and delete what was there."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm_path(f"{new}.replaced")
    had = fs.exists(jvm_path(path))
    if had and not fs.rename(jvm_path(path), old):
        raise OSError(f"could not move {path}")
    if not fs.rename(jvm_path(new), jvm_path(path)):
        if had:
            fs.rename(old, jvm_path(path))
        raise OSError(f"could not move {new} to {path}")
    if had:
        fs.delete(old, True)
