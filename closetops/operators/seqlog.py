"""Operators over sequence-numbered change logs (unit scans, fulfillment statuses).

A change log has an entity key, a sequence or time order and state columns.
The reports ask for the next state (LEAD), the previous state (LAG), the
newest row (via a pointer table holding the newest ``seq``) and the newest two
rows.

Skew.  A plain ``Window.partitionBy(key)`` sends every row of one entity to one
task.  ``shift_within`` therefore splits each entity's log into ranges of the
order column (``bucket``): LEAD/LAG run inside (key, bucket) windows, and the
row that crosses a bucket edge is taken from a per-(key, bucket) table of
first/last rows (one row per bucket, pre-aggregated before its shuffle).  The
result is exact for any bucket width; the width only bounds the rows one
window task holds.  The log itself is exchanged once, for the window, and keeps
that (key, bucket) partitioning for the join with the edge table.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import stage

# Default order-range per window task when the order column is a sequence number.
DEFAULT_SEQ_BUCKET = 1 << 20


def _sentinel(dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.lit("")
    if isinstance(dtype, (T.DateType,)):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(dtype)


def null_safe_keys(df: DataFrame, keys: list[str], prefix: str = "_nk") -> tuple[DataFrame, list[str]]:
    """Add plain-equality join columns that also match NULL to NULL.

    Each key becomes (coalesce(key, sentinel), key IS NULL).  Partitioning and
    joining on these *columns* lets a repartition, a grouped aggregate and a
    join-back share one exchange (Spark reuses it), where ``eqNullSafe`` join
    conditions would force another shuffle.
    """
    cols = {}
    names = []
    for i, k in enumerate(keys):
        v, n = f"{prefix}{i}", f"{prefix}{i}n"
        cols[v] = F.coalesce(F.col(k), _sentinel(df.schema[k].dataType))
        cols[n] = F.col(k).isNull()
        names += [v, n]
    return df.withColumns(cols), names


def group_count_back(df: DataFrame, keys: list[str], value: Column, out: str) -> DataFrame:
    """``COUNT(value) OVER (PARTITION BY keys)`` as a grouped count joined back.

    A large group is counted by partial aggregation instead of being held by one
    window task.  The join back has the exchange that Spark plans for it, so
    adaptive execution can split a hot key (an explicit repartition would stop
    that).  ``df`` is read twice: pass a stored table or a stage.
    """
    x, nk = null_safe_keys(df, keys)
    cnt = x.groupBy(*nk).agg(F.count(value).alias(out))
    return x.join(cnt, nk, "inner").drop(*nk)


def shift_within(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str],
                 direction: str = "lead", bucket: Column | None = None) -> DataFrame:
    """Add ``out = LEAD/LAG(src)`` over ``PARTITION BY keys ORDER BY order``.

    ``values`` maps output name -> source column.  ``order`` must be unique
    within a key (add a tie-break column otherwise).  ``bucket`` is an
    expression non-decreasing in ``order`` (e.g. ``floor(seq / 2^20)``); when
    None a single window per key is used.
    """
    fn = F.lead if direction == "lead" else F.lag
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({o: fn(F.col(s)).over(w) for o, s in values.items()})

    b = "_bkt"
    # In a struct a null bucket (null order value) equals itself in the join back, and sorts first.
    x, nk = null_safe_keys(df.withColumn(b, F.struct(bucket.alias("v"))), keys)
    part = nk + [b]
    # The window exchanges the log, on (key, bucket); the edges are combined before their exchange,
    # so only one row per key, bucket and task moves for them, and the join back moves nothing else.
    w = Window.partitionBy(*part).orderBy(*order)
    inner = x.withColumns({**{o: fn(F.col(s)).over(w) for o, s in values.items()},
                           "_has": fn(F.lit(1)).over(w)})
    # Edge row of every (key, bucket): first row for LEAD, last row for LAG.
    pick = F.min_by if direction == "lead" else F.max_by
    edge_struct = F.struct(*[F.col(s).alias(o) for o, s in values.items()])
    edges = x.groupBy(*part).agg(pick(edge_struct, F.struct(*order)).alias("_edge"))
    wb = Window.partitionBy(*nk).orderBy(b)
    nb = edges.select(*part, fn("_edge").over(wb).alias("_nb"))
    j = inner.join(nb, part, "left")
    return j.select(
        *[F.col(c) for c in df.columns],
        *[F.when(F.col("_has").isNull(), F.col("_nb")[o]).otherwise(F.col(o)).alias(o) for o in values])


#: Hash slots that rows are counted by, and the rows of a slot that one window task may hold
#: beyond four times the average slot's.
SLOTS, HEAVY_ROWS = 1 << 16, 1 << 17


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS))


def heavy_slots(log: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame | None:
    """Hash slots of ``keys`` with far more rows than the others (a key with many rows fills its slot);
    None if there are none, as in most logs.  One count per slot and task is moved, not one per key."""
    counts = log.groupBy(_slot(keys).alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    usual = counts.agg((F.sum("_n") * 4 / SLOTS).alias("_usual"))
    heavy = stage(counts.crossJoin(F.broadcast(usual)).where(F.col("_n") > F.col("_usual") + (HEAVY_ROWS if rows is None else rows))
                  .select("_slot"))
    return None if heavy.isEmpty() else heavy


def shift_split(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], direction: str,
                bucket: Column, heavy: DataFrame | None) -> DataFrame:
    """:func:`shift_within` by ``bucket`` for the rows of ``heavy`` slots alone, and by one window per key for
    the rest, which then move once: no edges are gathered or joined for keys that fit a task."""
    if heavy is None:
        return shift_within(df, keys, order, values, direction)
    x = df.withColumn("_slot", _slot(keys))
    few, many = (x.join(F.broadcast(heavy), "_slot", how).drop("_slot") for how in ("left_anti", "left_semi"))
    return shift_within(few, keys, order, values, direction).unionByName(
        shift_within(stage(many), keys, order, values, direction, bucket))


def next_state(log: DataFrame, as_of: str, key: str = "id", seq: str = "seq",
               ts: str = "updated_on", bucket_width: int | None = DEFAULT_SEQ_BUCKET) -> DataFrame:
    """Each scan with the time, action and station of the entity's next scan.

    The newest scan of an entity takes ``as_of`` as its next time (the report's
    "now").  ``aging_date`` is the scan time plus 48 hours.
    """
    bucket = F.floor(F.col(seq) / bucket_width) if bucket_width else None
    x = shift_within(log, [key], [seq],
                     {"_next_ts": ts, "next_action": "action",
                      "next_location_station": "location_station"},
                     "lead", bucket)
    return x.select(
        F.col(key), F.col(seq), "status", "barcode",
        F.col(ts).alias("cur_updated_on"),
        F.coalesce(F.col("_next_ts"), F.lit(as_of).cast("timestamp_ntz")).alias("next_updated_on"),
        F.col("action").alias("cur_action"), "next_action",
        F.col("location_site").alias("cur_location_site"),
        F.col("location_station").alias("cur_location_station"),
        "next_location_station",
        (F.col(ts) + F.expr("INTERVAL 48 HOURS")).alias("aging_date"),
    )


def current_row(log: DataFrame, pointer: DataFrame, key: str = "id", seq: str = "seq",
                ptr_key: str = "unit_id", ptr_seq: str = "seq") -> DataFrame:
    """Rows of ``log`` whose (key, seq) is the pointer's newest seq: an equi-join."""
    p = pointer.select(F.col(ptr_key).alias("_pk"), F.col(ptr_seq).alias("_ps"))
    return log.join(p, (log[key] == p["_pk"]) & (log[seq] == p["_ps"]), "inner").drop("_pk", "_ps")


def last_k_by_seq(log: DataFrame, pointer: DataFrame, k: int = 2, key: str = "id",
                  seq: str = "seq", ptr_key: str = "fulfillment_id", ptr_seq: str = "seq") -> DataFrame:
    """The newest ``k`` rows of each entity: ``log.seq BETWEEN ptr.seq-(k-1) AND ptr.seq``.

    Planned as an equi-join on the key with a range residual, so it shuffles on
    the key and never compares rows of different entities.
    """
    p = pointer.select(F.col(ptr_key).alias("_pk"), F.col(ptr_seq).alias("last_seq"))
    cond = (log[key] == p["_pk"]) & log[seq].between(p["last_seq"] - (k - 1), p["last_seq"])
    return log.join(p, cond, "inner").drop("_pk")


def row_number_within(df: DataFrame, keys: list[str], order: list, bucket: Column, out: str) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` without one window per key.

    Rows are numbered inside (key, bucket) windows; each bucket's offset is the
    number of rows of the key in earlier buckets, taken from a per-(key,
    bucket) count (pre-aggregated) with a running sum over the key's buckets.
    ``bucket`` must be non-decreasing in ``order``; ``order`` must be unique
    within a key for a deterministic numbering.
    """
    b = "_rn_b"
    x, nk = null_safe_keys(df.withColumn(b, F.struct(bucket.alias("v"))), keys)  # a null bucket equals itself
    part = nk + [b]
    inner = x.withColumn("_rn_in", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    counts = x.groupBy(*part).agg(F.count(F.lit(1)).alias("_rn_n"))
    wb = Window.partitionBy(*nk).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*part, F.coalesce(F.sum("_rn_n").over(wb), F.lit(0)).alias("_rn_off"))
    j = inner.join(offs, part, "inner")
    return j.select(*[F.col(c) for c in df.columns], (F.col("_rn_off") + F.col("_rn_in")).alias(out))
