"""Prefix trie of conversations by whole-sequence collapse.

Identical conversations are first collapsed into one weighted sequence with a
list of the conversations that end there; only the weighted sequences go on.
A sequence that is a proper prefix of another is dropped from the leaves by an
anti-join, and the nodes are the prefixes of the sequences, their weights
added up.

A prefix is named by 128 bits: the XOR of the hashes of (position, turn) over
its turns.  So a node's parent is its own name without the last turn, no
sequence is ever held as a whole, and a conversation of any length is dealt to
as many tasks as its turns fill: the turns are range-partitioned by
(conversation, turn), numbered and folded inside each partition, and the
partitions' totals carried on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import stage
from .common import n_words, small

#: Parents with more children than this are joined apart from the others.
HOT_CHILDREN = 10_000
#: Conversations that share their first turns with one donor, and the most turns taken from it.
FAMILY, MOST_SHARED = 20, 3

_KEY = ["depth", "a", "b"]
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _pieces(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows in that order over partitions, each with its partition's number ``part``, written once."""
    return stage(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))


def _carried(rows: DataFrame, value: Column, fold, zero: Column, order: str, name: str) -> DataFrame:
    """A running fold of ``value`` per conversation as column ``name``, taken piece by piece.

    The window inside a piece holds at most one partition's rows, the window
    over pieces one row per partition of a conversation.
    """
    inside = Window.partitionBy("conv", "part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy("conv", "part").agg(fold(value).alias("_t"))
              .select("conv", "part", F.coalesce(fold(F.col("_t")).over(ahead), zero).alias("_ahead")))
    return rows.withColumn(name, fold(value).over(inside)).join(totals, ["conv", "part"])


def numbered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, part, pos, x, y, words): every turn with its place in the conversation from 1.

    Turns are ordered by ``turn`` (null first), equal ones by role and text; null role and text
    are empty; x and y are hashes of (role, text).  Rows without a conversation are left out:
    there is no conversation to rebuild.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = stage(turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
        F.xxhash64(F.lit(1), "role", "text").alias("x"), F.xxhash64(F.lit(2), "role", "text").alias("y"),
        n_words(F.col("text")).alias("words")))
    one = _carried(placed, F.lit(1), F.sum, F.lit(0).cast("long"), "at", "pos")
    return one.select("conv", "part", (F.col("pos") + F.col("_ahead")).alias("pos"), "x", "y", "words")


def rebuilt(turns: DataFrame, family: int = FAMILY, shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) rebuilt: the first h turns of the family's first conversation
    (conv - conv % family), then the own turns after the first h; h = crc32(decimal conv) % (shared + 1).

    A donor has few heirs (its family) and gives them at most ``shared`` turns, so neither
    join has a hot key.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (shared + 1)
    convs = turns.groupBy("conv").agg(F.max("pos").alias("n")).withColumn("h", h).withColumn(
        "donor", F.col("conv") - F.col("conv") % family)
    convs = stage(convs)
    given = (convs.where("h > 0").select(F.col("conv").alias("heir"), "h", "donor")
             .join(turns.where(F.col("pos") <= shared).withColumnRenamed("conv", "donor"), "donor").where("pos <= h"))
    taken = convs.select(F.col("conv").alias("donor"), F.least("n", F.lit(shared)).alias("has"))
    convs = convs.join(taken, "donor", "left").select(
        "conv", "n", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("given"))
    own = (turns.join(convs.select("conv", "h", "given"), "conv").where("pos > h")
           .select("conv", "part", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "x", "y", "words"))
    first = given.select(F.col("heir").alias("conv"), F.lit(-1).alias("part"), "pos", "x", "y", "words")
    lengths = convs.select("conv", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))
    return lengths, first.unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, part, depth, a, b, pa, pb, words): the name of every prefix and of its parent."""
    x, y = F.xxhash64(F.lit(3), "pos", "x"), F.xxhash64(F.lit(4), "pos", "y")
    rows = stage(turns.select("conv", "part", F.col("pos").alias("depth"), x.alias("x"), y.alias("y"), "words"))
    inside = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (rows.groupBy("conv", "part").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
              .select("conv", "part", *[F.coalesce(F.bit_xor(c).over(ahead), F.lit(0).cast("long")).alias(f"t{c}")
                                        for c in "xy"]))
    out = (rows.withColumn("a", F.bit_xor("x").over(inside)).withColumn("b", F.bit_xor("y").over(inside))
           .join(totals, ["conv", "part"]))
    a, b = F.col("a").bitwiseXOR(F.col("tx")), F.col("b").bitwiseXOR(F.col("ty"))
    return out.select("conv", "part", "depth", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("pa"),
                      b.bitwiseXOR(F.col("y")).alias("pb"), "words")


def end_lists(ends: DataFrame) -> DataFrame:
    """(depth, a, b, part, first, ids): the conversations that end at a node, ascending, joined by
    commas, in chunks; a node with many is cut where the range partitions are."""
    cut = _pieces(ends.select(*_KEY, "conv"), *[F.col(c) for c in (*_KEY, "conv")])
    return cut.groupBy(*_KEY, "part").agg(
        F.min("conv").alias("first"), F.array_sort(F.collect_list("conv")).alias("ids")).select(
        *_KEY, "part", "first", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def _digests(lists: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256).  Lists of one chunk are hashed as they are; the chunks of the
    few longer ones are sorted and streamed through the hash, one chunk in memory at a time."""
    lists = stage(lists)
    several = lists.groupBy(*_KEY).count().where("count > 1").drop("count")
    one = lists.join(several, _KEY, "left_anti").select(*_KEY, F.sha2(F.col("ids"), 256).alias("ends_sha256"))

    def stream(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for p in parts:
            for key, ids in zip(zip(*(p[c].tolist() for c in _KEY)), p["ids"]):
                if key != now:
                    if now is not None:
                        yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*_KEY, "ends_sha256"])
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if now is not None:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*_KEY, "ends_sha256"])

    more = (lists.join(several, _KEY, "left_semi").repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
            .select(*_KEY, "ids").mapInPandas(stream, "depth long, a long, b long, ends_sha256 string"))
    return one.unionByName(more)


def trie(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie: conv (the smallest member), depth, parent (the parent node's conv, null
    for the root), n_convs, n_children, n_leaves, saved, ends_sha256.

    ``lengths`` (conv, len) lists all conversations, also those without turns; ``turns`` is
    (conv, part, pos, x, y, words), pos from 1 without gaps, and rising with part.
    """
    zero = F.lit(0).cast("long")
    paths = stage(prefixes(turns))
    last = paths.select("conv", F.col("depth").alias("len"), "a", "b")
    ends = stage(lengths.join(last, ["conv", "len"], "left").select(
        "conv", F.col("len").cast("long").alias("depth"), F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b")))
    lists = end_lists(ends)

    # collapse: one weighted sequence for all conversations with the same turns
    sequences = stage(ends.groupBy(*_KEY).agg(F.count("*").alias("weight"), F.min("conv").alias("conv")))
    steps = stage(paths.join(sequences.select("conv", "weight"), "conv"))
    inner = steps.select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
    leaves = sequences.join(inner, _KEY, "left_anti").select("conv", F.lit(1).alias("leaf"))
    heads = sequences.select("conv", F.lit(-2).alias("part"), zero.alias("depth"), zero.alias("a"), zero.alias("b"),
                             F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"),
                             zero.alias("words"), "weight")
    steps = stage(steps.withColumn("depth", F.col("depth").cast("long")).unionByName(heads)
                  .join(leaves, "conv", "left").withColumn("leaf", F.coalesce("leaf", F.lit(0))))

    # weighted prefixes; each node belongs to the sequence of its smallest member
    nodes = stage(steps.groupBy(*_KEY).agg(
        F.min("conv").alias("conv"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.max("words").alias("words"), F.max("pa").alias("pa"), F.max("pb").alias("pb")))
    own = nodes.select("conv", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    worth = stage(steps.select("conv", "part", *_KEY).join(own, ["conv", "depth"], "left")
                  .withColumn("saved", F.coalesce("saved", zero)))
    upto = _carried(worth, F.col("saved"), F.sum, zero, "depth", "upto")
    total = worth.groupBy("conv").agg(F.sum("saved").alias("total"))
    below = F.col("total") - F.col("_ahead") - F.col("upto") + F.col("saved")
    saved = upto.join(total, "conv").groupBy(*_KEY).agg(F.sum(below).alias("saved"))

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"),
                                                F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    full = stage(nodes.join(saved, _KEY).join(children, _KEY, "left").join(_digests(lists), _KEY, "left").select(
        *_KEY, "pa", "pb", "conv", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved",
        F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256")))
    return _with_parents(full)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Each node with its parent's conv; parents of very many children are joined apart, as few rows."""
    up = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"),
                                              F.col("b").alias("pb"), F.col("conv").alias("parent"), "n_children")
    hot = small(stage(up.where(F.col("n_children") > HOT_CHILDREN).drop("n_children")))
    rest = up.where(F.col("n_children") <= HOT_CHILDREN).drop("n_children")
    key = ["depth", "pa", "pb"]
    tops = nodes.where("depth = 0").withColumn("parent", F.lit(None).cast("long"))
    below = nodes.where("depth > 0")
    return tops.unionByName(below.join(hot, key)).unionByName(below.join(hot, key, "left_anti").join(rest, key))


def op12(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    Null roles and texts are empty; null turns come first; equal turns are ordered by role and
    text, and repeated rows are turns of their own; rows without conv_id are left out; a
    conversation left without turns is a member of the root only; an empty table gives no nodes;
    columns besides conv_id, turn, role and text are not read.
    """
    lengths, turns = rebuilt(stage(numbered(conversations)))
    return trie(lengths, turns).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")
