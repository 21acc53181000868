"""Aggregation building blocks.

``horizon_counts`` answers "how many distinct orders did this customer place
between day d and d + N" for several N at once without joining a customer's
rows to each other: orders are pre-aggregated to (customer, day) counts, and
one window per customer runs over those days together with the probe dates.
The window holds one row per order day and one per probe date, however many
orders a customer has, and each horizon is a RANGE frame of its days.

``cumulative`` replaces the triangular self-join ``a.m <= a1.m`` by a RANGE
window.

``count_distinct_ifs`` computes several ``COUNT(DISTINCT CASE WHEN c THEN id
END)`` over one frame by stacking (metric, id) pairs, de-duplicating them and
counting per metric, instead of Catalyst's Expand of every row per metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def horizon_counts(probes: DataFrame, events: DataFrame, key: str, anchor: str,
                   event_id: str, event_ts: str, horizons=(30, 60, 90, 180, 270, 365),
                   prefix: str = "orders_in_", suffix: str = "d") -> DataFrame:
    """Per distinct (key, anchor date): distinct events with ts in [anchor, anchor + N days].

    Both bounds are inclusive and the upper bound is midnight of day anchor+N,
    so an event at exactly that midnight counts and later ones that day do not.
    Orders with one time are counted per day.  An order with several times must
    count once per window, so these (and only these) are joined to the customer's
    probes and counted by their first time in the window.
    Probes with a NULL key or anchor get no row (callers left-join and read 0).
    """
    ev = (events.select(F.col(key).alias("_k"), F.col(event_id).alias("_id"),
                        F.col(event_ts).alias("_ts"))
          .filter(F.col("_k").isNotNull() & F.col("_id").isNotNull() & F.col("_ts").isNotNull()))
    orders = ev.groupBy("_k", "_id").agg(F.min("_ts").alias("_ts"), F.max("_ts").alias("_hi"))
    per_day = orders.filter("_ts = _hi").groupBy("_k", F.to_date("_ts").alias("_d")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(F.col("_ts") == F.to_date("_ts").cast("timestamp_ntz"), 1)).alias("_mid"))
    pr = (probes.select(F.col(key).alias("_k"), F.col(anchor).alias("_a"))
          .filter(F.col("_k").isNotNull() & F.col("_a").isNotNull()).distinct())
    # Order days and probes of a customer meet in one window.  Each probe sums the days of its horizon
    # (anchor .. anchor+N-1) and the midnight orders of day anchor+N, a frame of at most two rows a day.
    day = F.unix_date("_d")
    zero = F.lit(0).cast("bigint")
    rows = per_day.withColumn("_probe", F.lit(0)).unionByName(
        pr.select("_k", F.col("_a").alias("_d"), zero.alias("_n"), zero.alias("_mid"), F.lit(1).alias("_probe")))
    w = Window.partitionBy("_k").orderBy(day)
    run = (rows.select("_k", F.col("_d").alias("_a"), "_probe", *[
        (F.sum("_n").over(w.rangeBetween(0, n - 1)) + F.coalesce(F.sum("_mid").over(w.rangeBetween(n, n)), zero))
        .alias(f"{prefix}{n}{suffix}") for n in horizons])
           .filter(F.col("_probe") == 1).drop("_probe"))
    start = F.col("_a").cast("timestamp_ntz")

    def end(n):
        return F.date_add("_a", n).cast("timestamp_ntz")

    several = (ev.join(orders.filter("_ts < _hi").select("_k", "_id"), ["_k", "_id"], "left_semi")
               .join(pr, "_k").filter((F.col("_ts") >= start) & (F.col("_ts") <= end(max(horizons))))
               .groupBy("_k", "_a", "_id").agg(F.min("_ts").alias("_ts")).groupBy("_k", "_a")
               .agg(*[F.count(F.when(F.col("_ts") <= end(n), 1)).alias(f"_m{n}") for n in horizons]))
    both = run.join(several, ["_k", "_a"], "left")
    return both.select(F.col("_k").alias(key), F.col("_a").alias(anchor),
                       *[(F.col(f"{prefix}{n}{suffix}") + F.coalesce(f"_m{n}", F.lit(0))).alias(f"{prefix}{n}{suffix}")
                         for n in horizons])


def cumulative(df: DataFrame, key: str, order: str, value: Column, out: str) -> DataFrame:
    """``SUM(value)`` over rows of the same key with order <= this row's order (peers included)."""
    w = Window.partitionBy(key).orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def count_distinct_ifs(df: DataFrame, metrics: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row: for each name, ``COUNT(DISTINCT CASE WHEN cond THEN id END)``."""
    names = list(metrics)
    arr = F.array(*[F.struct(F.lit(n).alias("m"),
                             F.when(c, i.cast("string")).alias("v")) for n, (c, i) in metrics.items()])
    pairs = (df.select(F.explode(arr).alias("p"))
             .select(F.col("p.m").alias("m"), F.col("p.v").alias("v"))
             .filter(F.col("v").isNotNull()).distinct())
    per = pairs.groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(*[F.coalesce(F.max(F.when(F.col("m") == n, F.col("n"))), F.lit(0)).cast("bigint").alias(n)
                     for n in names])


def pair_counts(left: DataFrame, right: DataFrame, keys: list[str], label: str, n: str) -> DataFrame:
    """(keys, pairs, pairs_differing) of the join of two counted tables on ``keys``, without the join.

    ``left`` and ``right`` hold rows (keys, label, n), n being a number of rows; labels may repeat.
    The pairs of a key are sum(left) * sum(right); those of equal label are the sum over labels of
    the products, so those of differing labels (a null label differs from none and equals none) are
    the product over labelled rows less that.  A hot key is two grouped sums, combined before the
    shuffle.  Null keys match nothing; keys of one side only have no row.
    """
    def side(df: DataFrame, at: int) -> DataFrame:
        counted = df.select(*keys, label, *[(F.col(n) if i == at else F.lit(0).cast("bigint")).alias(f"_n{i}") for i in (0, 1)])
        return counted.dropna(subset=keys)

    per_label = side(left, 0).unionByName(side(right, 1)).groupBy(*keys, label).agg(
        F.sum("_n0").cast("decimal(38,0)").alias("_a"), F.sum("_n1").cast("decimal(38,0)").alias("_b"))
    named = F.col(label).isNotNull()
    zero = F.lit(0).cast("decimal(38,0)")
    per_key = per_label.groupBy(*keys).agg(
        F.sum("_a").alias("_l"), F.sum("_b").alias("_r"), F.sum(F.when(named, F.col("_a")).otherwise(zero)).alias("_ln"),
        F.sum(F.when(named, F.col("_b")).otherwise(zero)).alias("_rn"),
        F.sum(F.when(named, F.col("_a") * F.col("_b")).otherwise(zero)).alias("_same"))
    return per_key.where("_l > 0 AND _r > 0").select(
        *keys, (F.col("_l") * F.col("_r")).cast("decimal(38,0)").alias("pairs"),
        (F.col("_ln") * F.col("_rn") - F.col("_same")).cast("decimal(38,0)").alias("pairs_differing"))
