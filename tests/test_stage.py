import os

from closetops.operators import drop_staged, stage
from closetops.session import ensure_checkpoint_dir


def _files(folder):
    return sum(len(f) for _, _, f in os.walk(folder.replace("file:", "")))


def test_stage_writes_a_columnar_table_and_cuts_lineage(spark):
    folder = ensure_checkpoint_dir(spark)
    before = _files(folder)
    df = spark.range(1000).selectExpr("id", "id % 7 AS k")
    staged = stage(df)
    assert _files(folder) > before             # files written to the shared checkpoint folder
    plan = staged.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan          # later reads come from the table, not the lineage
    assert "Range" not in plan and "id" not in plan.split("ReadSchema")[-1]  # and are pruned
    assert staged.groupBy("k").count().count() == 7


def test_staged_tables_are_dropped(spark):
    folder = ensure_checkpoint_dir(spark)
    drop_staged(spark)
    before = _files(folder)
    stage(spark.range(10).toDF("id"))
    assert _files(folder) > before
    assert drop_staged(spark) == 1
    assert _files(folder) == before


def test_stage_keeps_schema_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string, c timestamp_ntz")
    staged = stage(df)
    assert staged.schema == df.schema and staged.count() == 0
