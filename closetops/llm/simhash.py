"""SimHash near-duplicates by a binary trie self-join.

The distinct fingerprints form a binary trie.  The self-join walks pairs of
trie nodes of equal depth, adds up the bits in which the two paths differ, and
drops a pair as soon as the sum exceeds the Hamming budget ``max_bits``.

On a cluster the top of that walk is a shuffle.  The 64 bits are cut into
``max_bits + 2`` blocks; two fingerprints within the budget agree in at least
two whole blocks, so for each choice of two blocks the trie is built over the
bits with these two in front, and only the node pairs on its diagonal (no
differing bit so far) are entered.  One node pair is then one row.  Node pairs
too large for one task are expanded level by level with joins (the children of
both nodes, budget checked) until they fit; the rest of the walk runs inside
the tasks on sorted arrays.  Every link within the budget is met in some
choice of blocks, so the groups are exact at any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..operators import stage
from .common import components

BITS = 64
#: Largest node (fingerprints) that a task walks; larger ones are expanded by joins first.
NODE_LIMIT = 1024
#: Trie levels that one round of joins expands.
STEP = 4
#: Node pairs with at most this many fingerprint pairs are compared at once.
LEAF_PAIRS = 4096

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of one text (see :func:`fingerprints`)."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    n, digest = len(grams), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 32768):
        part = grams[at:at + 32768]
        h = np.fromiter((digest(g, seed) for g in part), np.uint64, len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fp(shingle: int):
    @pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in s], np.uint64).view(np.int64))
    return fp


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp long): A-Z lower-cased, words between ASCII white space, word shingles with
    repeats (a shorter text: one shingle of all its words), XXH64 with seed 42; a bit is 1
    if it is set in over half the hashes.  Null, empty and blank texts have fingerprint 0."""
    return docs.select(F.col(id_col).alias("id"), _fp(shingle)(F.col(text_col)).alias("fp"))


def _layouts(max_bits: int) -> list[list[tuple[int, int]]]:
    """For each choice of two blocks: all blocks as (lowest bit, width), the chosen ones first."""
    n = max_bits + 2
    edges = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]
    return [[blocks[i] for i in c] + [x for i, x in enumerate(blocks) if i not in c]
            for c in combinations(range(n), 2)]


def _permuted(layout: list[tuple[int, int]]):
    """The fingerprint with its blocks in the layout's order, from the top bit down."""
    out, at = F.lit(0).cast("long"), BITS
    for lo, width in layout:
        at -= width
        part = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << width) - 1))
        out = out.bitwiseOR(F.shiftleft(part, at))
    return out


def _permute(fp: np.ndarray, layout: list[tuple[int, int]]) -> np.ndarray:
    out, at = np.zeros_like(fp), BITS
    for lo, width in layout:
        at -= width
        out |= ((fp >> np.uint64(lo)) & np.uint64((1 << width) - 1)) << np.uint64(at)
    return out


def _walk(a: np.ndarray, b: np.ndarray, same: bool, depth: int, max_bits: int) -> list[tuple[int, int]]:
    """Stars over the groups that the links between two trie nodes connect: pairs (centre, member) of
    positions, those of b counted on from those of a (if not the same node).

    a and b are sorted and hold the fingerprints below one node each, of the given
    depth.  Pairs of child nodes whose paths differ in too many bits are pruned.
    """
    shift = 0 if same else len(a)
    parent = list(range(len(b) + shift))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    todo = [(0, len(a), 0, len(b), depth, ((int(a[0]) ^ int(b[0])) >> (BITS - depth)).bit_count())]
    while todo:
        a0, a1, b0, b1, d, err = todo.pop()
        if err > max_bits or a0 == a1 or b0 == b1:
            continue
        if (a1 - a0) * (b1 - b0) <= LEAF_PAIRS or d == BITS:
            near = np.bitwise_count(a[a0:a1, None] ^ b[None, b0:b1]) <= max_bits
            for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
                x, y = root(a0 + i), root(b0 + j + shift)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            continue
        bit = np.uint64(BITS - 1 - d)
        am = a0 + int(np.count_nonzero((a[a0:a1] >> bit) & np.uint64(1) == 0))
        bm = b0 + int(np.count_nonzero((b[b0:b1] >> bit) & np.uint64(1) == 0))
        todo += [(a0, am, b0, bm, d + 1, err), (am, a1, bm, b1, d + 1, err), (a0, am, bm, b1, d + 1, err + 1)]
        if not (same and (a0, a1) == (b0, b1)):  # of a node with itself, one mixed pair of children is enough
            todo.append((am, a1, b0, bm, d + 1, err + 1))
    return [(r, x) for x in range(len(parent)) if (r := root(x)) != x]


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints (column fp) that connect the same groups as all links
    of at most ``max_bits`` bits.  Each node pair gives stars instead of its links, so no task emits
    all pairs of a group, and the groups settle in few rounds."""
    layouts = _layouts(max_bits)
    members = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.lit(x[0][1] + x[1][1]).alias("base"), _permuted(x).alias("path"))
        for c, x in enumerate(layouts)])).alias("m")).select("fp", "m.*")

    def node(level):
        return F.expr(f"shiftrightunsigned(path, {BITS} - least({BITS}, base + {level * STEP}))")

    @pandas_udf("array<struct<a:bigint,b:bigint>>")
    def spanning(c: pd.Series, depth: pd.Series, xs: pd.Series, ys: pd.Series) -> pd.Series:
        out = []
        for k, d, x, y in zip(c, depth, xs, ys):
            x = np.asarray(x, np.int64).view(np.uint64)
            x = x[np.argsort(px := _permute(x, layouts[k]))]
            px.sort()
            if same := y is None:
                y, py = x, px
            else:
                y = np.asarray(y, np.int64).view(np.uint64)
                y = y[np.argsort(py := _permute(y, layouts[k]))]
                py.sort()
            all_ = (x if same else np.concatenate([x, y])).view(np.int64).tolist()
            out.append([{"a": all_[i], "b": all_[j]} for i, j in _walk(px, py, same, int(d), max_bits)])
        return pd.Series(out)

    depth = F.expr(f"least({BITS}, base + level * {STEP})")
    pairs = stage(members.groupBy("c", "base", node(0).alias("node")).agg(F.count("*").alias("n")).where("n > 1")
                  .selectExpr("c", "base", "node AS a", "node AS b", "n AS na", "n AS nb"))
    level, found, small = 0, [], f"greatest(na, nb) <= {NODE_LIMIT}"
    while True:
        ready, big = pairs.where(small), pairs.where(f"NOT ({small})")
        asked = ready.select("c", F.explode(F.array("a", "b")).alias("node")).distinct()
        lists = (members.withColumn("node", node(level)).join(asked, ["c", "node"])
                 .groupBy("c", "base", "node").agg(F.collect_list("fp").alias("fps")))
        if level == 0:  # each node with itself
            work = lists.selectExpr("c", "base", "0 AS level", "fps AS xs", "cast(null AS array<bigint>) AS ys")
        else:
            lists = stage(lists)
            work = (ready.join(lists.selectExpr("c", "node AS a", "fps AS xs"), ["c", "a"])
                    .join(lists.selectExpr("c", "node AS b", "fps AS ys"), ["c", "b"])
                    .selectExpr("c", "base", f"{level} AS level", "xs", "CASE WHEN a <> b THEN ys END AS ys"))
        found.append(work.select(F.explode(spanning("c", depth, "xs", "ys")).alias("l")).select("l.*"))
        if big.isEmpty():
            break
        split = big.select("c", F.explode(F.array("a", "b")).alias("node")).distinct()
        below = stage(members.withColumn("node", node(level)).withColumn("child", node(level + 1))
                      .join(split, ["c", "node"]).groupBy("c", "node", "child").agg(F.count("*").alias("n")))
        pairs = stage(big.select("c", "base", "a", "b")
                      .join(below.selectExpr("c", "node AS a", "child AS ca", "n AS na"), ["c", "a"])
                      .join(below.selectExpr("c", "node AS b", "child AS cb", "n AS nb"), ["c", "b"])
                      .where(F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= max_bits)
                      .where("(a <> b OR ca <= cb) AND NOT (ca = cb AND na = 1)")
                      .selectExpr("c", "base", "ca AS a", "cb AS b", "na", "nb"))
        level += 1
    out = found[0]
    for x in found[1:]:
        out = out.unionAll(x)
    return out


def _grouped(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, head, component_id) of each distinct fingerprint of ``fps`` (id, fp): the least fingerprint of its
    component and the least id there."""
    distinct = stage(fps.groupBy("fp").agg(F.min("id").alias("first")))
    comp = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    comp = comp.join(distinct, "fp")
    least = comp.groupBy("component").agg(F.min("first").alias("least"))
    grouped = comp.join(least, "component").select("fp", "component", "least")
    return distinct.join(grouped, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("head"), F.coalesce("least", "first").alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per input row: (id, fp, component_id), the smallest id that is reachable over
    fingerprints at most ``max_bits`` bits apart, the row's own included.

    Null ids are linked like others; they are the component's id only where no member has
    another one.  Repeated rows each get their row.  An empty table gives no rows.  Further
    columns of ``docs`` are ignored, whatever their names.
    """
    fps = stage(fingerprints(docs, id_col, text_col, shingle))
    return fps.join(_grouped(fps, max_bits).drop("head"), "fp").select("id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each connected group exactly one, whatever the ids.

    It is a row with the least id of the group (null only if all are), of these one with the least
    fingerprint.  Rows that share an id are told apart by their fingerprint; of equal ones any stays.
    Null texts are empty; an empty table gives no rows; further columns stay, whatever their names.
    """
    fps = stage(fingerprints(docs, id_col, text_col, shingle))
    heads = (fps.join(_grouped(fps, max_bits), "fp").where("id <=> component_id")
             .groupBy("head").agg(F.first("id").alias("__keep"), F.min("fp").alias("__fp")))
    # an id on one row of the input needs no fingerprint; the others' are worked out again
    keep = stage(heads.select("__keep", "__fp"))
    held = stage(fps.join(keep, F.col("id").eqNullSafe(F.col("__keep")), "left_semi").groupBy("id").count()
                 .where("count > 1").select(F.col("id").alias("__rep")))
    once = keep.join(held, F.col("__keep").eqNullSafe(F.col("__rep")), "left_anti")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # no name clashes inside
    row_id = F.col("row").getField(id_col)
    kept = rows.join(once, row_id.eqNullSafe(F.col("__keep")), "left_semi")
    if held.isEmpty():
        return kept.select("row.*")
    again = rows.join(held, row_id.eqNullSafe(F.col("__rep")), "left_semi")
    with_fp = again.select("row", row_id.alias("__id"), _fp(shingle)(F.col("row").getField(text_col)).alias("__f"))
    one = with_fp.join(keep, F.col("__id").eqNullSafe(F.col("__keep")) & (F.col("__f") == F.col("__fp")), "left_semi")
    return kept.unionByName(one.dropDuplicates(["__id", "__f"]).select("row")).select("row.*")


def op2(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
