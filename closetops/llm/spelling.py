"""Spelling variants: words one edit apart, found by walking a trie as a relation.

The vocabulary is written as two tries, one over the words and one over the
words read backwards; a trie is a table of edges (node, character, child).  A
frontier of states (word, position, node, edits) is joined with the edges of
one depth after the other: a state goes on along the edge of its word's next
character, and one without an edit also along the others (a replaced
character) or over a character of its word (a deleted one); an inserted
character is a deleted one of the other word.  A state with one edit that ends
its word in a node where a word ends has found a neighbour.

The first half of a word or its last half is free of the edit, so each trie
lets words in at half their length and allows edits only below, where nodes
have few children: the frontier stays a small multiple of the vocabulary.
Words longer than ``LONG`` code points, whose depths would each be a join of
few rows, are compared by what is left of them after one deletion (an equi-join
on hashes, verified).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType

from ..operators import stage

#: Words up to this many code points meet in the tries.
LONG = 48
#: Distinct words that a task counts before it hands the counts on.
HELD = 200_000
#: One in so many (document, run) pairs loses a code point.
SLIP = 199

_LOWER = {c: c + 32 for c in range(65, 91)}
_P, _B = (1 << 61) - 1, 1_000_003


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip: int = SLIP,
         least: int = 6) -> DataFrame:
    """(word, n): words of at least ``least`` code points and how often the texts hold them.

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased.  A run whose
    crc32 of ``<id>:<run>`` is divisible by ``slip`` loses the code point crc % length (a null id
    is written as nothing).  Each task adds up what it meets before the shuffle, up to HELD
    distinct words at a time.
    """
    letters = re.compile("[A-Za-zÀ-ÿ]+")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()

        def handed() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})
            seen.clear()
            return out

        for p in parts:
            for i, text in zip(p["id"], p["text"]):
                head = f"{i or ''}:".encode()
                for run, n in Counter(letters.findall((text or "").translate(_LOWER))).items():
                    if len(run) < least:
                        continue
                    h = zlib.crc32(run.encode(), zlib.crc32(head))
                    if h % slip == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < least:
                            continue
                    seen[run] += n
                if len(seen) >= HELD:
                    yield handed()
        if seen:
            yield handed()

    got = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(
        count, "word string, n long")
    return got.groupBy("word").agg(F.sum("n").alias("n"))


def edges(words: DataFrame) -> DataFrame:
    """(way, depth, node, ch, child, ends): the edges of the trie of each way at depths from half a
    word's length on, a node being the string that leads to it; ``ends`` if a word ends in the child."""
    steps = words.select("way", "word", F.length("word").alias("len"),
                         F.explode(F.sequence(F.floor(F.length("word") / 2).cast("int"),
                                              F.length("word") - 1)).alias("depth"))
    return steps.select(
        "way", "depth", F.substring("word", F.lit(1), F.col("depth")).alias("node"),
        F.substring("word", F.col("depth") + 1, F.lit(1)).alias("ch"),
        F.substring("word", F.lit(1), F.col("depth") + 1).alias("child"), (F.col("depth") + 1 == F.col("len")).alias("end"),
    ).groupBy("way", "depth", "node", "ch", "child").agg(F.max("end").alias("ends"))


def walked(vocabulary: DataFrame) -> DataFrame:
    """(word, other): pairs of words up to LONG code points that are one edit apart, in one or both orders.

    The states of a depth are written once; the next depth and the neighbours are read from there.
    """
    words = vocabulary.where(F.length("word") <= LONG).select("word")
    both = words.select(F.lit("f").alias("way"), "word").unionAll(words.select(F.lit("b"), F.reverse("word")))
    both = stage(both)
    trie = stage(edges(both))
    bounds = both.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    found = None
    states = None  # (way, word, pos, node, edits)
    for depth in range(bounds[0] // 2, bounds[1]) if bounds[0] else ():
        entering = both.where((F.floor(F.length("word") / 2) == depth) & (F.length("word") > depth)).select(
            "way", "word", F.lit(depth).alias("pos"), F.substring("word", 1, depth).alias("node"), F.lit(0).alias("edits"))
        front = entering if states is None else states.where("pos < length(word)").unionByName(entering)
        front = front.unionByName(front.where("edits = 0").select(
            "way", "word", (F.col("pos") + 1).alias("pos"), "node", F.lit(1).alias("edits")))
        step = front.join(trie.where(F.col("depth") == depth).drop("depth"), ["way", "node"])
        same = F.substring("word", F.col("pos") + 1, F.lit(1)) == F.col("ch")
        other = (F.col("edits") == 0) & (F.col("ch") > F.substring("word", F.col("pos") + 1, F.lit(1)))
        states = stage(step.where(same | other).select(
            "way", "word", (F.col("pos") + 1).alias("pos"), F.col("child").alias("node"),
            (F.col("edits") + F.when(same, 0).otherwise(1)).alias("edits"), "ends"))
        ended = states.where("edits = 1 AND pos = length(word) AND ends").select("way", "word", F.col("node").alias("other"))
        found = ended if found is None else found.unionAll(ended)
        states = states.drop("ends")
    # the last character deleted: the state ends where it stands, in a node that must be a word
    shorter = both.select("way", "word", F.expr("left(word, length(word) - 1)").alias("other"))
    last = shorter.join(both.select("way", F.col("word").alias("other")), ["way", "other"]).select("way", "word", "other")
    found = last if found is None else found.unionAll(last)
    back = F.col("way") == "b"
    return found.select(F.when(back, F.reverse("word")).otherwise(F.col("word")).alias("word"),
                        F.when(back, F.reverse("other")).otherwise(F.col("other")).alias("other"))


@pandas_udf(ArrayType(LongType()))
def _shortened(words: pd.Series) -> pd.Series:
    """Hashes of a word without each of its characters in turn."""
    def each(word: str) -> list[int]:
        codes = [ord(c) + 1 for c in word]
        tail, power, after = 0, 1, [(0, 1)]
        for c in reversed(codes):
            tail, power = (c * power + tail) % _P, power * _B % _P
            after.append((tail, power))
        head, out = 0, []
        for c, (rest, scale) in zip(codes, reversed(after[:-1])):
            out.append((head * scale + rest) % _P)
            head = (head * _B + c) % _P
        return out
    return words.map(each)


@pandas_udf(LongType())
def _hashed(words: pd.Series) -> pd.Series:
    def one(word: str) -> int:
        h = 0
        for c in word:
            h = (h * _B + ord(c) + 1) % _P
        return h
    return words.map(one)


def long_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, other): pairs one edit apart of which one at least has more than LONG code points."""
    words = stage(vocabulary.where(F.length("word") >= LONG).select("word", _hashed("word").alias("h")))
    cut = stage(words.where(F.length("word") > LONG).select("word", F.posexplode(_shortened("word")).alias("at", "h")))
    replaced = cut.join(cut.select(F.col("word").alias("other"), "at", "h"), ["at", "h"]).where("word < other")
    deleted = cut.join(words.select(F.col("word").alias("other"), "h"), "h")
    pairs = replaced.select("word", "other").unionAll(deleted.select("word", "other")).distinct()
    return pairs.where(F.levenshtein("word", "other", 1) == 1)


def near(vocabulary: DataFrame) -> DataFrame:
    """(word, other): every pair of distinct words one inserted, deleted or replaced code point
    apart, in both orders, once each."""
    pairs = walked(vocabulary).unionAll(long_pairs(vocabulary))
    return pairs.unionAll(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"))).distinct()


def forms(vocabulary: DataFrame, pairs: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the most frequent near word (ties: the smallest) if it
    is at least ``times`` as frequent, and the last word on the way of forms.

    Forms rise in n by that factor, so a way has no circle, and doubling the steps ends it in a
    few rounds, whatever the size.
    """
    best = (pairs.join(vocabulary.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
            .groupBy("word").agg(F.count("*").alias("n_near"),
                                 F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")))
    likely = -F.col("best.m") >= times * F.col("n")
    table = stage(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(likely, F.col("best.other")).alias("form"), F.when(likely, -F.col("best.m")).alias("form_n")))
    way = stage(table.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stage(way.join(onward, "root", "left").select("word", "root", "next"))
        way = longer.select("word", F.coalesce("next", "root").alias("root"))
        if longer.where("next IS NOT NULL").isEmpty():
            break
    return table.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(docs: DataFrame) -> DataFrame:
    """One row per word of at least 6 code points that occurs at least 5 times.

    Null and empty texts hold no words; a null doc_id is written as nothing before the colon;
    repeated rows count again; a document or word of any length is taken whole; equal counts go
    to the smaller word; an empty table gives no rows; columns besides doc_id and text are not read.
    """
    vocabulary = stage(runs(docs).where("n >= 5"))
    return forms(vocabulary, near(vocabulary))
