"""Mixing sources to target weights with a time-varying curriculum.

Each source has a schedule: its weight as a piecewise linear function of
training time (0 to 1).  The integral of the schedule is the source's share of
the mix.  A source's documents stand in a fixed pseudo-random order, repeated
in whole passes; the document that begins at word w of that sequence is
trained at the time at which the source's cumulative demand (the integrated
schedule) reaches w.  Sorting by these times interleaves the sources as the
schedules ask, without a step-by-step simulation.

Positions inside a source come from prefix sums in two levels: the order key
is an MD5, its leading digits cut each source into buckets of bounded size,
and a window runs over the buckets' totals and inside each bucket.  No window
holds a whole source, however large.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import stage
from .common import n_words

#: Schedules as (time, weight) knots with integral 1: front-loaded, even, back-loaded.
CURRICULA = (((0, 1.75), (0.5, 0.75), (1, 0.75)), ((0, 1.0), (1, 1.0)), ((0, 0.75), (0.5, 0.75), (1, 1.75)))
#: Long-run weights, given to the sources in turn.
WEIGHTS = (3, 1, 2)
#: Documents that one bucket of a source holds at most, about.
BUCKET_ROWS = 2000


def integral(knots: Sequence[tuple[float, float]]) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def inverse_sql(share: str, knots: Sequence[tuple[float, float]]) -> str:
    """SQL for the time at which the integrated schedule has reached ``share`` (0 to 1) of its total."""
    total, done, arms = integral(knots), 0.0, ""
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        d = f"({share} * {total!r}e0 - {done!r}e0)"
        done += (t1 - t0) * (w0 + w1) / 2
        slope = 2 * (w1 - w0) / (t1 - t0)
        at = f"{float(t0)!r}e0 + CASE WHEN {d} <= 0 THEN 0e0 ELSE 2e0 * {d} / ({float(w0)!r}e0 + sqrt({float(w0) ** 2!r}e0 + {slope!r}e0 * {d})) END"
        arms += f" WHEN {share} * {total!r}e0 < {done!r}e0 THEN {at}"
    return f"(CASE{arms} ELSE 1e0 END)"


def targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float,
            curricula: Sequence) -> DataFrame:
    """(source, source_size, shape, target) for (source, source_size).

    The mix takes ``share`` times all words, split by weight times integrated
    schedule over the sources (in order of code points, null last).  A source
    whose part would exceed ``cap`` times its size gets just that and the excess
    goes to the others by weight, until none exceeds: sources are filled in order
    of cap / weight, and the level is the first that the next source's cap
    exceeds.  One row per source, the table of the mixture's settings, goes
    through one task.
    """
    w = [float(weights[i % len(weights)] * integral(curricula[i % len(curricula)]))
         for i in range(math.lcm(len(weights), len(curricula)))]
    every = Window.partitionBy()
    before = Window.orderBy("room", "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
              .withColumn("shape", F.col("rank") % len(curricula))
              .withColumn("weight", F.element_at(F.array(*map(F.lit, w)), (F.col("rank") % len(w) + 1).cast("int")))
              .withColumn("most", F.col("source_size") * F.lit(float(cap)))
              .withColumn("room", F.col("most") / F.col("weight"))
              .withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share))
                                    - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
                          / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
              .withColumn("level", F.min_by("level", F.when(F.col("level") <= F.col("room"), F.struct("room", "rank")))
                          .over(every)))
    return ranked.select("source", "source_size", "shape",
                         F.coalesce(F.least("most", F.col("weight") * F.col("level")), "most").alias("target"))


def plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
         weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
         curricula: Sequence = CURRICULA, whole: bool = False, rows: bool = False) -> DataFrame:
    """One row per input row: id, source, size (words), source_size, target, taken (words that the
    mix takes, repeats counted), copies (array of struct(copy, position) of the passes that take it).

    A source's words are taken in its order until the target is met: the last
    document is cut there, or with ``whole`` taken whole if its middle lies before the
    target.  ``rows`` adds the input row as struct ``row``.

    Null texts and texts without a word have size 0 and are taken with no words where
    their place lies before the target; null sources form one source; null ids and
    repeated rows are rows like others (full repeats are interchangeable).  An empty
    table gives no rows.  Further columns never clash: they are only kept in ``row``.
    """
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"),
                       F.coalesce(F.col(text_col), F.lit("")))).alias("h"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []))
    if not rows:
        sized = stage(sized)
    narrow = sized.select("source", "size", "h")
    digits = max(1, math.ceil(math.log(max(1, docs.count() / BUCKET_ROWS), 16)))
    bucket = F.substring("h", 1, digits)
    parts = stage(narrow.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")))
    goal = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap, curricula)
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = (parts.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words")
             .withColumnRenamed("source", "s").withColumnRenamed("bucket", "b")
             .join(goal.withColumnRenamed("source", "s2"), F.col("s").eqNullSafe(F.col("s2"))).drop("s2"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    seated = (sized.withColumn("bucket", bucket)
              .withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
              .withColumn("at", F.col("ahead") + F.col("inside")))
    goal_words = F.col("target") if whole else F.floor("target")
    words, copies = F.lit(0).cast("long"), []
    for k in range(math.ceil(cap)):
        at = F.col("at") + F.col("source_size") * k
        if whole:
            part = F.when(2 * at + F.col("size") < 2 * goal_words, F.col("size")).otherwise(0)
            hit = (2 * at + F.col("size") < 2 * goal_words)
        else:
            part = F.greatest(F.lit(0), F.least(F.col("size"), goal_words - at))
            hit = (part > 0) | ((F.col("size") == 0) & (at < goal_words))
        if k:  # a text without words is no repeat
            hit = hit & (F.col("size") > 0)
        words = words + part
        copies.append(F.when(hit, F.struct(F.lit(k).alias("copy"), (at / goal_words).alias("u"))))
    times = F.expr("CASE shape " + " ".join(
        f"WHEN {i} THEN transform(c, x -> struct(x.copy AS copy, {inverse_sql('x.u', s)} AS position))"
        for i, s in enumerate(curricula)) + " END")
    return (seated.withColumn("taken", words.cast("long")).withColumn("c", F.filter(F.array(*copies), lambda x: x.isNotNull()))
            .select("id", "source", "size", "source_size", "target", "taken", times.alias("copies"),
                    *(["row"] if rows else [])))


def mixed(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it, sorted by
    training position (ties by id); documents are taken whole.  Columns as in ``docs``."""
    taken = plan(docs, id_col=id_col, whole=True, rows=True, **how)
    return (taken.select("row", "id", F.explode("copies").alias("c"))
            .orderBy("c.position", "id").select("row.*"))


def op1(docs: DataFrame) -> DataFrame:
    return (plan(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken",
                              F.get("copies", F.lit(0))["position"].alias("position"))
            .orderBy("position", "doc_id"))
