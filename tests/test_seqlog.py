import datetime as dt
import re

from pyspark.sql import functions as F

from closetops.operators.seqlog import next_state, shift_within


def _log(spark):
    t = dt.datetime(2024, 1, 1)
    rows = []
    # unit 1: many scans (crosses several buckets of width 3), unit 2: one scan, unit 3: ties in time
    for i in range(10):
        rows.append((1, i * 2, "ACTIVE", "91234567", t + dt.timedelta(hours=30 * i), f"a{i}", "S1", f"ST{i}"))
    rows.append((2, 5, "ACTIVE", "11111111", t, "only", "S2", "X"))
    rows.append((3, 100, "ACTIVE", "12345678", t, "p", "S1", "Y"))
    rows.append((3, 101, "ACTIVE", "12345678", t, "q", "S1", "Z"))
    return spark.createDataFrame(rows, "id bigint, seq bigint, status string, barcode string, "
                                       "updated_on timestamp_ntz, action string, location_site string, "
                                       "location_station string")


def test_bucketed_lead_equals_window(spark):
    log = _log(spark)
    plain = next_state(log, as_of="2024-03-01", bucket_width=None)
    for width in (1, 3, 7, 1 << 20):
        b = next_state(log, as_of="2024-03-01", bucket_width=width)
        assert sorted(map(tuple, b.collect())) == sorted(map(tuple, plain.collect())), width


def test_last_row_takes_as_of(spark):
    log = _log(spark)
    r = {x["id"]: x for x in next_state(log, as_of="2024-03-01", bucket_width=3)
         .filter(F.col("next_action").isNull()).collect()}
    assert r[2]["next_updated_on"] == dt.datetime(2024, 3, 1)
    assert r[1]["seq"] == 18


def test_lag_bucketed(spark):
    log = _log(spark)
    plain = shift_within(log, ["id"], ["seq"], {"prev": "action"}, "lag")
    b = shift_within(log, ["id"], ["seq"], {"prev": "action"}, "lag", F.floor(F.col("seq") / 4))
    assert sorted(map(tuple, b.collect())) == sorted(map(tuple, plain.collect()))


def test_hot_unit_is_split_across_buckets(spark):
    """One unit holds two thirds of the log: the LEAD is exact and its windows are per (unit, bucket)."""
    t = dt.datetime(2024, 1, 1)
    rows = [(0, i, "ACTIVE", "91234567", t + dt.timedelta(minutes=i), "a", "S", "X") for i in range(0, 1200, 2)]
    rows += [(u, 1 + 2 * u + k, "ACTIVE", "11111111", t + dt.timedelta(minutes=u + k), "b", "S", "Y")
             for u in range(1, 100) for k in range(3)]
    log = spark.createDataFrame(rows, "id bigint, seq bigint, status string, barcode string, "
                                      "updated_on timestamp_ntz, action string, location_site string, "
                                      "location_station string")
    split = next_state(log, as_of="2024-03-01", bucket_width=64)
    plain = next_state(log, as_of="2024-03-01", bucket_width=None)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_nk0#\d+L?, _nk0n#\d+, _bkt#\d+L?", plan), plan[:500]
    buckets = log.filter("id = 0").select(F.floor(F.col("seq") / 64)).distinct().count()
    assert buckets >= 18  # the hot unit's rows are spread over many window tasks
