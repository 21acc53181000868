"""Benchmark items inside documents, by MinHash containment search.

A test item is short and a document may be thousands of times longer, so
their Jaccard similarity says nothing; what counts is the part of the item's
word shingles that the document holds.  The items are partitioned by size
(powers of two of their distinct shingles), and each partition gets its own
sketch length: of an item with at most u shingles the floor((1 - t) u) + 1
shingles of least hash, its bottom-k MinHash.  A document that holds a part t
of the item lacks at most floor((1 - t) u) of its shingles, so it holds at
least one of the sketch: the search misses no document.  Candidates are then
verified on the shingles themselves.

DataFrame functions only.  Documents are exploded into shingle hashes that
are joined to the sketches at once; only hits are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import stage
from .common import small, word_array

SHINGLE, THRESHOLD = 5, 0.8


def _grams(words: DataFrame, width: int, text: bool) -> DataFrame:
    """Explode column ``words`` into hash ``h`` (and string ``s`` if text) of each run of ``width`` words."""
    run = [F.get("words", F.col("i") + j) for j in range(width)]
    out = (words.where(F.size("words") >= width)
           .withColumn("i", F.explode(F.sequence(F.lit(0), F.size("words") - width)))
           .withColumn("h", F.xxhash64(*run)).withColumn("width", F.lit(width)))
    return (out.withColumn("s", F.concat_ws(" ", *run)) if text else out).drop("words", "i")


def _words(table: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return table.select(F.col(id_col).alias(name), F.xxhash64(text).alias(f"{name}_text"),
                        word_array(F.lower(text)).alias("words"))


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
              threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (id, id_text, item, n_shared, n_item, containment) with containment >= threshold.

    Shingles are runs of ``shingle`` words (lower case, between ASCII white space), each distinct
    one counted once; an item of fewer words is one shingle of all of them.  Items and texts
    without a word are in no pair.  id_text is a hash of the text: rows with the same id and
    different texts are told apart, repeated rows give one pair.  Null ids are ids.  Further
    columns of either table are ignored.
    """
    bag = _words(items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")),
                 "item_id", "text", "item")
    widths = sorted(r[0] for r in bag.where("size(words) > 0")
                    .select(F.least(F.size("words"), F.lit(shingle))).distinct().collect())  # at most `shingle` rows
    key = ["id", "id_text"]
    if not widths:
        return (_words(docs, id_col, text_col, "id").where("false")
                .selectExpr("id", "id_text", "cast(null AS bigint) AS item", "0L AS n_shared", "0L AS n_item",
                            "0D AS containment"))

    def short(w):  # of the items with fewer words all make one shingle
        return bag.where(F.size("words") == w) if w < shingle else bag.where(F.size("words") >= w)

    grams = stage(reduce(DataFrame.unionAll, [_grams(short(w), w, True) for w in widths]).distinct())
    item = ["item", "item_text"]
    counted = grams.join(grams.groupBy(*item).agg(F.count("*").alias("n_item"))
                         .withColumnRenamed("item", "i").withColumnRenamed("item_text", "t"),
                         F.col("item").eqNullSafe(F.col("i")) & (F.col("item_text") == F.col("t"))).drop("i", "t")
    upper = F.expr("shiftleft(2L, cast(floor(log2(n_item)) AS int)) - 1")  # largest size of the partition
    length = F.floor((1 - threshold) * upper + 1e-9) + 1
    counted = stage(counted)
    sketch = (counted.withColumn("r", F.row_number().over(Window.partitionBy(*item).orderBy("h", "s")))
              .where(F.col("r") <= length).select("width", "h").distinct())
    words = _words(docs, id_col, text_col, "id")
    hits = stage(reduce(DataFrame.unionAll, [
        _grams(words, w, False).join(sketch.where(F.col("width") == w).select("h"), "h", "left_semi").select(*key)
        for w in widths]).distinct())
    found = words.join(small(hits).withColumnsRenamed({"id": "i", "id_text": "t"}),
                       F.col("id").eqNullSafe(F.col("i")) & (F.col("id_text") == F.col("t")), "left_semi")
    shared = (reduce(DataFrame.unionAll, [_grams(found, w, True) for w in widths])
              .join(counted, ["width", "h", "s"]).select(*key, *item, "n_item", "s").distinct()
              .groupBy(*key, *item, "n_item").agg(F.count("*").alias("n_shared")))
    part = F.col("n_shared") / F.col("n_item")
    return (shared.withColumn("containment", part).where(F.col("containment") >= threshold)
            .select(*key, "item", "n_shared", "n_item", "containment"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item.

    Null and empty texts hold none and stay; a null id is an id; of rows that share an id those
    go whose text holds an item; repeated rows go or stay together; empty tables are no special
    case; further columns stay, whatever their names.
    """
    bad = stage(contained(docs, items, id_col, text_col).select(F.col("id").alias("__i"), F.col("id_text").alias("__t")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    return rows.join(small(bad), F.col("row").getField(id_col).eqNullSafe(F.col("__i"))
                     & (F.xxhash64(text) == F.col("__t")), "left_anti").select("row.*")


def op7(docs: DataFrame, items: DataFrame) -> DataFrame:
    return (contained(docs, items).groupBy(F.col("id").alias("doc_id"), F.col("item").alias("item_id"))
            .agg(F.max("n_shared").alias("n_shared"), F.max("n_item").alias("n_item"),
                 F.max("containment").alias("containment")))
