"""What several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import stage

#: A word: a run of anything but the six ASCII white-space characters (Java and RE2 syntax).
WORD = r"[^\x20\x09-\x0D]+"
#: The ASCII white space that ``bytes.split()`` and WORD agree on, for ``btrim``.
SPACE = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def word_array(text: Column) -> Column:
    """The words of a text in order; an empty array for a null or blank one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


#: Rows of a few fixed-size columns that may be broadcast: some tens of MB.
BROADCAST_ROWS = 500_000


#: Links of two small values that a task of a contraction round holds.
LINKS_PER_TASK = 100_000


def small(table: DataFrame) -> DataFrame:
    """A staged narrow table, marked for broadcast only if its counted rows are within BROADCAST_ROWS."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def components(links: DataFrame) -> DataFrame:
    """Connected components of a table of links (a, b), as rows (node, component).

    ``component`` is the smallest node of the group.  Alternating large-star and
    small-star rounds turn the links into one star per group; each round is two
    grouped minima joined back to the links, staged, so no group is ever held in
    one task and the driver only sees the count of nodes not yet settled.  Links
    that already are stars end it without a round.  Null ends and self links are
    ignored; nodes without a link don't appear.
    """
    a, b = F.col("a"), F.col("b")
    star = stage(links.where(a.isNotNull() & b.isNotNull() & (a != b))
                 .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    tasks = -(-star.count() // LINKS_PER_TASK) or 1  # coalesce() only ever lowers the number of tasks
    while _unsettled(star, tasks):
        both = star.select(a.alias("u"), b.alias("v")).unionAll(star.select(b.alias("u"), a.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
        large = stage(both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                      .coalesce(tasks).distinct().coalesce(tasks))
        low = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        star = stage(large.join(low, "a").where("b <> m").select(b.alias("a"), F.col("m").alias("b")).coalesce(tasks)
                     .unionAll(low.select("a", F.col("m").alias("b"))).distinct().coalesce(tasks))
    return star.select(a.alias("node"), b.alias("component")).unionAll(
        star.select(b.alias("node"), b.alias("component")).distinct().coalesce(tasks))


def _unsettled(star: DataFrame, tasks: int) -> int:
    """Nodes that have two parents, or a parent and a child."""
    return (star.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionAll(star.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
            .groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .where("up > 1 OR (up = 1 AND down = 1)").coalesce(tasks).count())
