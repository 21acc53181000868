"""Reusable relational building blocks composed from DataFrame operations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def stage(df: DataFrame) -> DataFrame:
    """Write an intermediate that several branches of one plan read, and read it back.

    Spark recomputes a DataFrame for every consumer; a result that feeds a
    grouped count *and* the join back would be built twice.  The analyses stage
    such results as tables (CREATE TABLE .. AS); here the rows go once to
    Parquet in the session's checkpoint folder (the cluster's shared
    ``spark.checkpoint.dir``).  Readers prune columns and push filters, and a
    lost executor re-reads the table instead of redoing the joins.  The write
    is a job of its own, run when this function is called; its shuffle files,
    which nothing reads afterwards, are deleted when it ends, or else they would lie on
    the disks until the driver happens to collect its garbage.  The stage's files are
    deleted when the session's JVM ends, or earlier by :func:`drop_staged`.
    """
    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    old = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, old)
    fs, where = _fs(spark, path)
    fs.deleteOnExit(where)
    _STAGED.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


_STAGED: list = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _fs(spark, path):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def unstage(df: DataFrame) -> None:
    """Delete what :func:`stage` wrote for this table, once nothing that is still to run reads it."""
    names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    for x in [x for x in _STAGED if x[1].rsplit("/", 1)[-1] in names]:
        fs, where = _fs(*x)
        fs.delete(where, True)
        _STAGED.remove(x)


def drop_staged(spark) -> int:
    """Delete what :func:`stage` wrote for this session; call it once the
    results are stored (DataFrames built on the stages can't be read after).
    Returns the number of tables dropped."""
    mine = [x for x in _STAGED if x[0] is spark]
    for x in mine:
        fs, where = _fs(spark, x[1])
        fs.delete(where, True)
        _STAGED.remove(x)
    return len(mine)
