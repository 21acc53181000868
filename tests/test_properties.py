"""Properties of whole query outputs."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from closetops.plans import ageing, order_issues
from closetops.registry import _wh

from conftest import SF_SMALL

Q = entry.queries()


def test_ageing_bins_sum_to_total(spark):
    df = Q["q_ageing_bins"](spark, SF_SMALL)
    s = sum(F.col(c) for c in ageing.BIN_NAMES)
    assert df.count() > 0
    assert df.filter(s != F.col("total")).count() == 0  # every stretch is >= 48 h, so it lands in a bin


def test_loyalty_horizons_nest(spark):
    for name in ("q_loyalty_all", "q_loyalty_po"):
        df = Q[name](spark, SF_SMALL)
        cols = [f"orders_in_{n}d" for n in order_issues.HORIZONS]
        bad = df.filter(" OR ".join(f"{a} > {b}" for a, b in zip(cols, cols[1:])))
        assert bad.count() == 0, name
        assert df.agg(F.max(cols[-1])).first()[0] > 0


def test_anti_plus_semi_is_all(spark):
    wh = _wh(spark, SF_SMALL)
    ogr = wh.order_group_reservation
    rpl = order_issues.replacements(wh.yp_autumn_full, ogr).select(F.col("group_id").alias("_rg")).distinct()
    cond = F.col("group_id") == F.col("_rg")
    anti = ogr.join(rpl, cond, "left_anti").count()
    semi = ogr.join(rpl, cond, "left_semi").count()
    assert anti + semi == ogr.count() and semi > 0
