"""Rows that can't meet a join's other side, left out before they move.

A join of a long table with few keys moves the whole table to find out which rows it needs.  The
keys' hashes are marked in a bitmap, as wide as the keys ask for up to MOST_BITS (32 MB), that is
broadcast; rows whose hash is not marked stay where they are.  A hash marks three bits of one word of 64, so
that a key costs one row when the bitmap is made, and few others pass while there are 8 bits a key or more.
The marks may be other keys', so the join itself is still to be made: its result is the same.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import stage

#: Bits of a bitmap for each key, and at least and at most in all; bits to a row of it (2 to this power).
BITS_PER_KEY, LEAST_BITS, MOST_BITS, ROW_BITS = 16, 1 << 16, 1 << 28, 12
#: Types whose equal values have equal hashes.
HASHED = (T.StringType(), T.LongType(), T.IntegerType(), T.ShortType(), T.DateType())


class KeyBits(NamedTuple):
    """The bitmap (block, bits: 64 longs) of the keys' hashes, its number of bits and the keys' type."""
    table: DataFrame
    bits: int
    of: T.DataType


def _slot(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits).cast("long"))


def _at(slot: Column, low: int) -> Column:
    """Bits low .. low + 5 of ``slot``."""
    return F.shiftright(slot, low).bitwiseAND(F.lit(63)).cast("int")


def _marks(key: str) -> Column:
    """The bits of its word that a key marks: by its hash's highest bits, which the slot doesn't use."""
    one = lambda low: F.call_function("shiftleft", F.lit(1).cast("long"), _at(F.xxhash64(key), low))
    return one(58).bitwiseOR(one(52)).bitwiseOR(one(46))


def key_bits(keys: DataFrame, key: str) -> KeyBits:
    """The bitmap of column ``key``, written once; ``keys`` is read twice: pass a stored table, a stage or a scan."""
    known = keys.select(key).where(F.col(key).isNotNull())
    bits = max(LEAST_BITS, min(MOST_BITS, 1 << (BITS_PER_KEY * known.count()).bit_length()))
    slot = _slot(key, bits)
    words = known.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(_marks(key)).alias("bits"))
    blocks = words.groupBy(F.shiftright("at", ROW_BITS - 6).alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct(_at(F.col("at"), 0).alias("i"), "bits"))).alias("m"))
    row = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long")))
    return KeyBits(stage(blocks.select("block", row.alias("bits"))), bits, keys.schema[key].dataType)


def stored_with_bits(rows: DataFrame, key: str) -> tuple[DataFrame, KeyBits]:
    """``rows`` written once, and the bitmap of their ``key``."""
    stored = stage(rows)
    return stored, key_bits(stored, key)


#: A table, or a view given as a function of the bitmap: the view's rows that may meet it, so that it can leave
#: others out beneath its own joins.
Asked = DataFrame | Callable[[KeyBits], DataFrame]


def asked(table: Asked, held: KeyBits) -> DataFrame:
    return table if isinstance(table, DataFrame) else table(held)


def may_meet(rows: DataFrame, key: str, held: KeyBits) -> DataFrame:
    """``rows`` without those whose ``key`` is surely none of the keys of ``held``; null keys may go or stay.
    Keys of another type than the bitmap's, or of one that isn't hashed by value, all stay."""
    if rows.schema[key].dataType != held.of or held.of not in HASHED:
        return rows
    slot = _slot(key, held.bits)
    word = F.get(F.col("_kb_bits"), _at(slot, 6))
    marked = word.bitwiseAND(_marks(key)) == _marks(key)
    table = held.table.select(F.col("block").alias("_kb_block"), F.col("bits").alias("_kb_bits"))
    return rows.join(F.broadcast(table), (F.shiftright(slot, ROW_BITS) == F.col("_kb_block")) & marked, "left_semi")
