import tempfile

import __spark_entry__ as entry
from closetops.sources.sinks import publish

from conftest import SF_SMALL


def test_publish_partitioned_and_read_back(spark):
    df = entry.queries()["q_unit_usage"](spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="closetops-publish-", dir="/tmp")
    publish(df, path=f"{out}/fact", partition_by=["order_type"])
    back = spark.read.parquet(f"{out}/fact")
    assert back.count() == df.count()
    assert set(back.columns) == set(df.columns)
    # partition pruning: a filter on the partition column reaches the file index
    plan = back.filter("order_type = 'QUEUE'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_type" in plan
