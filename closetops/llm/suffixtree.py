"""Language-model scores from a probabilistic suffix tree over words.

The states of the tree are contexts of one to ``depth`` words.  A context is a
candidate if it and a token after it were seen together at least ``least``
times in the training texts, and it is retained by a divergence test: over
those tokens its next-token distribution must beat that of the context without
its first word by ``worth`` nats (occurrences times log ratio) per token.  The
suffixes of a retained context are states too.  A state s spreads

    P(a | s) = (count(s a) + rest(s) P(a | s without its first word)) / (count(s) + 1)

over its next tokens: tokens that followed at least ``least`` times have their
counts, all others share the rest, count(s) + 1 less those counts, as the
shorter context deals them.  The root is the add-one unigram distribution.  A
token is scored in the longest suffix of what precedes it that is a state.

Reading.  The texts are cut into tokens once and staged as codes, one row for
about GATHERED tokens of whole texts, with the hashes of the words used there.

Counting.  Level after level the codes are read twice; a task counts the
(k+1)-grams both of whose k-grams were frequent (a bitmap of fixed size that may
say yes too often).  Most of them are rare, so the first time only 40 bits of
their names are counted, sent as sorted blocks of a range of names each, the
ranges as many as the tokens ask for.  The second time those that may be
frequent by that are counted by their whole names; these counts are exact.
Tokens and n-grams are named by 64-bit hashes.

Scoring.  Written along the chain of suffixes, ln P is a sum: the unigram term,
ln(rest(s) / (count(s) + 1)) for each state met, and for each counted pair of
state and token the log of what it gains over that.  Each n-gram thus has one
fixed weight, a text's score is the sum of the weights of its n-grams, and no
state has to be looked for position by position.  N-grams that make up at least
one in ``HEAVY`` of all tokens are broadcast (there can't be more than HEAVY of
one length); the others meet their weights in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from ..operators import stage, unstage

#: Longest context in words, least count of a context with its next token, nats a stored count must be worth.
DEPTH, LEAST, WORTH = 3, 16, 10.0
#: An n-gram is broadcast if it makes up at least one in so many tokens; 24 bytes a word, 16 a longer one.
HEAVY = 8_000_000
#: Tokens that a task gathers before it hands them on (a longer text is one row all the same).
GATHERED = 1_000_000
#: Distinct words whose hashes a task keeps from one gathering to the next.
KEPT = 250_000
#: Tokens of whole texts that a task works on at once (a longer text is one piece all the same).
PIECE = 1 << 17
#: Tokens to a range of names, whose blocks one task merges.
RANGE = 1_000_000
#: Bits of the bitmaps.
SLOTS = 1 << 26

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_END = np.uint64(xxhash.xxh64_intdigest(b" "))  # no word holds a space


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of an n-gram from those of its first and its last n - 1 tokens."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + ((b << np.uint64(29)) | (b >> np.uint64(35)))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


class _Words(dict):
    """A code for each distinct word, from 0; ``names`` has their hashes by code."""

    def __init__(self):
        super().__init__()
        self.names = [int(_END)]

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self.names)
        self.names.append(xxhash.xxh64_intdigest(word))
        return code


_CODES = "names binary, codes binary, lengths binary, ids array<string>, held array<boolean>"


def _packed(values: np.ndarray) -> bytes:
    """Numbers compressed byte by byte: the upper bytes are mostly zero."""
    return pa.compress(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unpacked(packed: pa.Scalar, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed.as_buffer(), 8 * n, "zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _CODES from (text, id, held_out): the hashes by code, the codes of the tokens, the tokens of
    each text.  Code 0 is the end of a text."""
    words, texts, ids, held, n = _Words(), [], [], [], 0

    def whole():
        code = np.concatenate(texts)
        used = np.bincount(code, minlength=len(words.names)) > 0
        return pa.RecordBatch.from_arrays([
            pa.array([np.array(words.names, np.uint64)[used].tobytes()], pa.binary()),
            pa.array([_packed((np.cumsum(used) - 1)[code])], pa.binary()),
            pa.array([np.array([len(x) for x in texts], np.int32).tobytes()], pa.binary()),
            pa.array([ids], pa.list_(pa.string())), pa.array([held], pa.list_(pa.bool_()))],
            ["names", "codes", "lengths", "ids", "held"])

    for batch in batches:
        for at in range(batch.num_rows):
            text, i, h = batch.column(0)[at], batch.column(1)[at].as_py(), batch.column(2)[at].as_py()
            found = (text.as_buffer().to_pybytes() if text.is_valid else b"").translate(_LOWER).split()
            code = np.zeros(len(found) + 1, np.int64)
            code[:-1] = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
            texts.append(code)
            ids.append(i)
            held.append(h)
            n += len(code)
            if n >= GATHERED:
                yield whole()
                texts, ids, held, n = [], [], [], 0
                if len(words) >= KEPT:
                    words = _Words()
    if texts:
        yield whole()


def _read(batches: Iterator[pa.RecordBatch], learn: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list, list]]:
    """(hashes by code, codes of the tokens, place of each token in its text, ids, held out) of each row of
    _CODES; only of the texts that aren't held out, without ids, if they are to learn from."""
    for batch in batches:
        for i in range(batch.num_rows):
            names = np.frombuffer(batch.column("names")[i].as_buffer(), np.uint64)
            length = np.frombuffer(batch.column("lengths")[i].as_buffer(), np.int32).astype(np.int64)
            code = _unpacked(batch.column("codes")[i], int(length.sum()))
            ids, held = ([], batch.column("held")[i].as_py()) if learn else (batch.column(c)[i].as_py() for c in ("ids", "held"))
            if learn and any(held):
                kept = ~np.array(held)
                code, length = code[np.repeat(kept, length)], length[kept]
            yield names, code, np.arange(len(code)) - np.repeat(np.cumsum(length) - length, length), ids, held


def tokenised(docs: DataFrame, text_col: str = "text", id_col: str | None = None, held_out: Column | None = None) -> DataFrame:
    """The texts as rows of _CODES, staged."""
    ident = F.lit(None) if id_col is None else F.col(id_col)
    held = F.lit(False) if held_out is None else held_out
    return stage(docs.select(F.col(text_col).alias("text"), ident.cast("string").alias("id"), held.alias("held_out"))
                 .mapInArrow(_gathered, _CODES))


def _tally(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and their counts."""
    first = np.nonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))[0] if len(sorted_keys) else np.zeros(0, int)
    return sorted_keys[first], np.diff(np.append(first, len(sorted_keys)))


def _in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64(SLOTS - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _bitmap(keys: DataFrame):
    """A bitmap of the keys' lowest bits, of fixed size, broadcast to Python workers."""
    slot = F.col("key").bitwiseAND(F.lit(SLOTS - 1))
    got = (keys.select(F.shiftright(slot, 6).cast("int").alias("at"),
                       F.expr("shiftleft(1L, CAST(key & 63 AS INT))").alias("bit"))
           .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    bitmap = np.zeros(SLOTS // 64, np.uint64)
    bitmap[got["at"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def unigrams(codes: DataFrame) -> DataFrame:
    """(key, n): the tokens of the texts and the end of each, counted."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, tokens, *_ in _read(batches, learn=True):
            n = np.bincount(tokens, minlength=len(names))
            used = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([names[used].view(np.int64), n[used]], ["key", "n"])
    return codes.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


@pandas_udf(LongType())
def _named(pre: pd.Series, suf: pd.Series) -> pd.Series:
    return pd.Series(_mix(pre.to_numpy(np.int64).view(np.uint64), suf.to_numpy(np.int64).view(np.uint64)).view(np.int64))


def _pieces(at: np.ndarray) -> Iterator[slice]:
    """About PIECE tokens each, cut between texts: no n-gram goes over a cut.  ``at``: places in their texts."""
    start = np.nonzero(at == 0)[0]
    first = start[np.diff(start // PIECE, prepend=-1) > 0]
    return map(slice, first.tolist(), [*first[1:].tolist(), len(at)])


def _pairs(names: np.ndarray, code: np.ndarray, at: np.ndarray, bitmaps: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams one token longer than those of the last bitmap, by the names of the n-grams they begin and end
    with; only where both may be in that bitmap.  One piece of the texts after the other."""
    word = _in(bitmaps[0].value, names)
    for piece in _pieces(at):
        token, to = code[piece], at[piece]
        known = word[token]
        place = np.nonzero(known[1:] & known[:-1] & (to[1:] > 0))[0]
        pre, suf, ends = names[token[place]], names[token[place + 1]], place + 1
        for k, bitmap in enumerate(bitmaps[1:], 2):
            name = _mix(pre, suf)
            known = _in(bitmap.value, name)
            both = np.nonzero(known[1:] & known[:-1] & (ends[1:] == ends[:-1] + 1) & (to[ends[1:]] >= k))[0]
            pre, suf, ends = name[both], name[both + 1], ends[both + 1]
        yield pre, suf


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def likely(codes: DataFrame, bitmaps: list, least: int, tokens: int) -> DataFrame:
    """(key): the low 40 bits of the names of the longer n-grams that all n-grams with these bits make up ``least`` of."""
    low, ranges = np.uint64((1 << 40) - 1), np.uint64(min(1 + tokens // RANGE, 1 << 24))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, code, at, *_ in _read(batches, learn=True):
            key = _joined([_mix(pre, suf) & low for pre, suf in _pairs(names, code, at, bitmaps)])
            key.sort()
            key, n = _tally(key)
            part = ((key >> np.uint64(16)) * ranges) >> np.uint64(24)
            spans = np.split(np.arange(len(key)), np.nonzero(part[1:] != part[:-1])[0] + 1) if len(key) else []
            yield pa.RecordBatch.from_arrays([
                pa.array([int(part[s[0]]) for s in spans], pa.int32()), pa.array([len(s) for s in spans], pa.int32()),
                pa.array([_packed(np.diff(key[s].view(np.int64), prepend=0)) for s in spans], pa.binary()),
                pa.array([_packed(n[s]) for s in spans], pa.binary())], ["part", "size", "keys", "counts"])

    def merged(table: pa.Table) -> pa.Table:
        keys, counts = [], []
        for i, size in enumerate(table["size"].to_pylist()):
            keys.append(np.cumsum(_unpacked(table["keys"][i], size)))
            counts.append(_unpacked(table["counts"][i], size))
        key, n = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key)
        key, n = key[order], n[order]
        first = np.nonzero(np.concatenate(([True], key[1:] != key[:-1])))[0]
        return pa.table({"key": key[first][np.add.reduceat(n, first) >= least]})

    return (codes.mapInArrow(blocks, "part int, size int, keys binary, counts binary")
            .groupBy("part").applyInArrow(merged, "key long"))


def longer(codes: DataFrame, bitmaps: list, asked) -> DataFrame:
    """(pre, suf, n): the longer n-grams whose names may be in the bitmap ``asked``, counted."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, code, at, *_ in _read(batches, learn=True):
            begins, stops = [], []
            for pre, suf in _pairs(names, code, at, bitmaps):
                use = _in(asked.value, _mix(pre, suf))
                begins.append(pre[use])
                stops.append(suf[use])
            pre, suf = _joined(begins), _joined(stops)
            _, first, n = np.unique(_mix(pre, suf), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pre[first].view(np.int64), suf[first].view(np.int64), n], ["pre", "suf", "n"])
    return codes.mapInArrow(count, "pre long, suf long, n long").groupBy("pre", "suf").agg(F.sum("n").alias("n"))


class Tree:
    """A fitted tree: the table ``weights`` (key, n, c, w) of all tokens and weighted n-grams (c: the
    token's count, 0 for longer ones; w: what an occurrence adds to log10 P beyond the unigrams), the
    states by length, and the numbers of training tokens and of distinct ones."""

    def __init__(self, weights: DataFrame, states: list[DataFrame], tokens: int, distinct: int, depth: int):
        self.weights, self.states, self.tokens, self.distinct, self.depth = weights, states, tokens, distinct, depth


def fit(docs: DataFrame, text_col: str = "text", depth: int = DEPTH, least: int = LEAST, worth: float = WORTH,
        codes: DataFrame | None = None) -> Tree:
    """The tree of the texts; ``codes``: what :func:`tokenised` made of them and of texts held out, if it is there."""
    codes = tokenised(docs, text_col) if codes is None else codes
    words = stage(unigrams(codes))
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    room = F.lit(float(total + distinct + 1))

    # grams[k]: frequent (k+1)-grams as key, pre, suf, n and p, the share of n among what follows pre
    none = F.lit(None).cast("long")
    grams = [stage(words.where(F.col("n") >= least).select(
        "key", none.alias("pre"), none.alias("suf"), "n", ((F.col("n") + 1) / room).alias("p"), F.lit(0.0).alias("gain")))]
    bitmaps = []
    for _ in range(depth):
        bitmaps.append(_bitmap(grams[-1].select("key")))
        asked = _bitmap(likely(codes, bitmaps, least, total))
        found = longer(codes, bitmaps, asked).where(F.col("n") >= least)
        found = stage(found.select(_named("pre", "suf").alias("key"), "pre", "suf", "n"))
        pre = grams[-1].select(F.col("key").alias("pre"), F.col("n").alias("c"))
        suf = grams[-1].select(F.col("key").alias("suf"), F.col("p").alias("lower"))
        p = F.col("n") / F.col("c")
        grams.append(stage(found.join(pre, "pre").join(suf, "suf").select(
            "key", "pre", "suf", "n", p.alias("p"), (F.col("n") * F.log(p / F.col("lower"))).alias("gain"))))

    # states, from the longest: divergent contexts and the suffixes of longer states
    states: list[DataFrame] = [None] * depth
    suffixes = None
    for k in reversed(range(depth)):
        after = grams[k + 1].groupBy(F.col("pre").alias("key")).agg(
            F.sum("gain").alias("gain"), F.count("*").alias("edges"), F.sum("n").alias("counted"))
        context = grams[k].drop("gain").join(after, "key")
        passed = F.col("gain") >= worth * F.col("edges")
        if suffixes is not None:
            context = context.join(suffixes.withColumn("asked", F.lit(True)), "key", "left")
            passed = passed | F.col("asked").isNotNull()
        states[k] = stage(context.where(passed).select(
            "key", "suf", "n", (F.col("n") - F.col("counted") + 1).alias("rest")))
        suffixes = states[k].select(F.col("suf").alias("key")).distinct() if k else None

    # weights: a state's back-off and what a counted pair of state and token gains over it
    zero = F.lit(0).cast("long")
    parts = [words.select("key", "n", F.col("n").alias("c"), F.lit(0.0).alias("w"))]
    probs = grams[0].select("key", "p")
    for k in range(depth):
        back = F.col("rest") / (F.col("n") + 1)
        parts.append(states[k].select("key", "n", zero.alias("c"), F.log10(back).alias("w")))
        state = states[k].select(F.col("key").alias("pre"), "rest", F.col("n").alias("of"))
        pairs = stage(grams[k + 1].select("key", "pre", "suf", "n").join(state, "pre")
                      .join(probs.select(F.col("key").alias("suf"), F.col("p").alias("lower")), "suf")
                      .select("key", "n", "rest", "of", "lower",
                              ((F.col("n") + F.col("rest") * F.col("lower")) / (F.col("of") + 1)).alias("p")))
        parts.append(pairs.select("key", "n", zero.alias("c"), F.log10(
            F.col("p") * (F.col("of") + 1) / (F.col("rest") * F.col("lower"))).alias("w")))
        probs = pairs.select("key", "p")
    weights = parts[0]
    for part in parts[1:]:
        weights = weights.unionAll(part)
    weights = stage(weights.groupBy("key").agg(F.max("n").alias("n"), F.max("c").alias("c"), F.sum("w").alias("w")))
    return Tree(weights, states, int(total), int(distinct), depth)


_SCORED = ("id string, held_out boolean, n_tokens long, n_known long, logs double, w double, "
           "keys array<long>, times array<int>")


def score(docs: DataFrame, tree: Tree, id_col: str = "doc_id", text_col: str = "text",
          held_out: Column | None = None, codes: DataFrame | None = None, heavy: int = HEAVY) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, base_score, score; ``codes`` as in :func:`fit`."""
    codes = tokenised(docs, text_col, id_col, held_out) if codes is None else codes
    sc = docs.sparkSession.sparkContext
    is_heavy = F.col("n") * heavy >= max(tree.tokens, 1)

    def table(rows: DataFrame, *columns: str) -> list[np.ndarray]:
        got = rows.where(is_heavy).select(*columns).toArrow()
        key = got["key"].to_numpy().view(np.uint64)
        order = np.argsort(key)
        return [key[order], *(got[c].to_numpy()[order] for c in columns[1:])]

    words = table(tree.weights.where("c > 0"), "key", "c", "w")
    words[1] = np.log10(words[1] + 1.0)
    top = sc.broadcast((words, table(tree.weights.where("c = 0"), "key", "w")))
    longer_ones = _bitmap(tree.weights.where("c = 0").select("key"))
    # other bits of those to be joined: else what the first bitmap lets pass wrongly moves, the more the larger the tree
    joined = _bitmap(tree.weights.where("c = 0").where(~is_heavy).select(F.shiftrightunsigned("key", 32).alias("key")))
    depth = tree.depth

    def found(keys: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spot = np.minimum(np.searchsorted(keys, names), max(len(keys) - 1, 0))
        return spot, keys[spot] == names if len(keys) else np.zeros(len(names), bool)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (words, logs, w), (grams, w_gram) = top.value
        for names, code, at, ids, held in _read(batches, learn=False):
            spot, hit = found(words, names)
            of_word = [np.where(hit, x[spot], 0.0) if len(words) else np.zeros(len(names)) for x in (logs, w)]
            done = 0
            for piece in _pieces(at):
                token, to = code[piece], at[piece]
                doc = np.cumsum(to == 0) - 1
                n_docs = int(doc[-1]) + 1
                n_tokens = np.bincount(doc, minlength=n_docs)
                known = hit[token]
                n_known = np.bincount(doc[known], minlength=n_docs)
                base, more = (np.bincount(doc, x[token], n_docs) for x in of_word)
                key = names[token]
                light = [(doc[~known], key[~known])]
                for k in range(1, depth + 1):  # the n-grams one token longer
                    key, doc, to = _mix(key[:-1], key[1:]), doc[1:], to[1:]
                    use = np.nonzero((to >= k) & _in(longer_ones.value, key))[0]
                    name, of = key[use], doc[use]
                    spot, there = found(grams, name)
                    if there.any():
                        more += np.bincount(of[there], w_gram[spot[there]], n_docs)
                    rest = np.nonzero(~there)[0]
                    rest = rest[_in(joined.value, name[rest] >> np.uint64(32))]
                    light.append((of[rest], name[rest]))
                of, name = (np.concatenate(x) for x in zip(*light))
                by = np.lexsort((name, of))
                of, name = of[by], name[by]
                new = np.ones(len(of), bool)
                new[1:] = (of[1:] != of[:-1]) | (name[1:] != name[:-1])
                first = np.nonzero(new)[0]
                times = np.diff(np.append(first, len(of))).astype(np.int32)
                cuts = np.searchsorted(of[first], np.arange(n_docs + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[done:done + n_docs], pa.string()), pa.array(held[done:done + n_docs], pa.bool_()),
                    pa.array(n_tokens), pa.array(n_known), pa.array(base), pa.array(more),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(name[first].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(times))],
                    ["id", "held_out", "n_tokens", "n_known", "logs", "w", "keys", "times"])
                done += n_docs

    rows = stage(codes.mapInArrow(look, _SCORED).withColumn("row", F.monotonically_increasing_id()))
    asked = rows.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x")).select(
        "row", F.col("x.keys").alias("key"), F.col("x.times").alias("times"))
    rare = tree.weights.where(~is_heavy).select("key", "c", "w")
    more = asked.join(rare, "key").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_more"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("logs_more"), F.sum(F.col("times") * F.col("w")).alias("w_more"))
    base = (F.col("logs") + F.coalesce("logs_more", F.lit(0.0))
            - F.col("n_tokens") * F.log10(F.lit(float(tree.tokens + tree.distinct + 1))))
    return rows.drop("keys", "times").join(more, "row", "left").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias("id"), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("n_more", F.lit(0))).alias("n_known"), base.alias("base_score"),
        (base + F.col("w") + F.coalesce("w_more", F.lit(0.0))).alias("score"))


def op11(docs: DataFrame, **how) -> DataFrame:
    """Scores of all texts by the tree learnt from those whose crc32(doc_id as text) mod 7 is not 2.

    Null, empty and blank texts are their end alone; a null doc_id has no remainder and is learnt
    from; repeated rows are learnt from and scored each; texts of any length are read whole; with
    no training texts every token is unknown (score 0: log10 of 1/1); an empty table gives no rows;
    columns besides doc_id and text are not read.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    codes = tokenised(docs, "text", "doc_id", held)
    tree = fit(docs, codes=codes, **how)
    got = score(docs, tree, codes=codes)
    unstage(codes)  # the scores only read what was found for each text
    return got.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known",
                      F.lit(tree.tokens).cast("long").alias("train_tokens"), "base_score", "score")
