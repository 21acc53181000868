"""SparkSession construction for tests, the bench and local runs.

On a cluster the session comes from the platform; the library never creates
one itself.  ``ensure_checkpoint_dir`` keeps a cluster-provided
``spark.checkpoint.dir`` and only falls back to a scratch folder when none is
configured (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every plan assumes: UTC wall clock for NTZ arithmetic,
# ANSI semantics, adaptive execution with skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.ui.enabled": "false",
    # staged (checkpointed) intermediates are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "closetops", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CLOSETOPS_DRIVER_MEM", "12g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder.

    The cluster's shared ``spark.checkpoint.dir`` is used when set.  Only a
    local-mode session (tests, bench) without one gets a scratch folder; on a
    cluster a machine-local folder would not be readable by other executors,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: staged report results are "
                           "checkpointed there")
    path = tempfile.mkdtemp(prefix="closetops-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
