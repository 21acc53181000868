"""The suffix tree's scores against a plain model that looks for the longest state at every token."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from closetops.llm import suffixtree

END = ("end",)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), END]


def brute(rows, depth, least, worth):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows]
    train = [tokens(t) for (_, t, *_), h in zip(rows, held) if not h]
    count = Counter(tuple(x[i:i + k]) for x in train for k in range(1, depth + 2) for i in range(len(x) - k + 1))
    uni = {g[0]: n for g, n in count.items() if len(g) == 1}
    total, distinct = sum(uni.values()), len(uni)

    def root(a):
        return (uni.get(a, 0) + 1) / (total + distinct + 1)

    def raw(s, a):
        return count[(*s, a)] / count[s] if s else root(a)
    after = defaultdict(dict)
    for g, n in count.items():
        if len(g) > 1 and n >= least:
            after[g[:-1]][g[-1]] = n
    states = {s for s, nx in after.items()
              if sum(n * math.log(raw(s, a) / raw(s[1:], a)) for a, n in nx.items()) >= worth * len(nx)}
    states = {s[i:] for s in states for i in range(len(s))}

    def p(s, a):
        if not s:
            return root(a)
        c, got = count[s], after[s]
        return (got.get(a, 0) + (c + 1 - sum(got.values())) * p(s[1:], a)) / (c + 1)
    out = []
    for (i, t, *_), h in zip(rows, held):
        x, score = tokens(t), 0.0
        for at, a in enumerate(x):
            s = next((tuple(x[j:at]) for j in range(max(0, at - depth), at) if tuple(x[j:at]) in states), ())
            score += math.log10(p(s, a))
        out.append((i, h, len(x), sum(a in uni for a in x), total, sum(math.log10(root(a)) for a in x), score))
    return out, states


def rows_of(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "THE", "the"]
    chain = {w: rng.sample(words, 3) for w in words}
    rows = []
    for i in range(120):
        w = rng.choice(words)
        x = []
        for _ in range(rng.choice([0, 1, 2, 3, 30, 80])):
            x.append(w)
            w = rng.choice(chain[w.strip("!")]) if rng.random() < 0.9 else rng.choice(words)
        if i % 3 == 0:
            x += "one two three four five six seven".split()
        rows.append((i, rng.choice([" ", "\n\t"]).join(x), "k", 1))
    return rows + rows[:4] + [(None, "a b the", "k", 1), (None, None, "k", 2), (3, "", "k", 2), (16, "new unseen the", "k", 3),
                              (200, "the " * 20000, "k", 0)]


@pytest.mark.parametrize("depth, least, gathered, heavy", [(3, 3, 2_000_000, 1_000_000), (3, 4, 100, 30), (1, 2, 50, 1)])
def test_against_a_plain_model(spark, monkeypatch, depth, least, gathered, heavy):
    monkeypatch.setattr(suffixtree, "GATHERED", gathered)
    monkeypatch.setattr(suffixtree.score, "__defaults__", (*suffixtree.score.__defaults__[:-1], heavy))
    rows = rows_of(depth)
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n long")
    want, states = brute(rows, depth, least, 2.0)
    got = [tuple(r) for r in suffixtree.op11(docs, depth=depth, least=least, worth=2.0).collect()]
    def order(r):
        return r[0] is not None, r[0], r[2], r[5]
    assert len(got) == len(want) and len({len(s) for s in states}) == depth
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-6)


def test_probabilities_of_a_state_sum_to_one(spark):
    texts = [(i, "x y " * 30) for i in range(9)] + [(i, f"x z{i}") for i in range(9, 14)]
    tree = suffixtree.fit(spark.createDataFrame(texts, "doc_id long, text string"), depth=1, least=5, worth=1.0)
    weight = {r.key: r for r in tree.weights.collect()}
    names = {w: np.uint64(xxhash.xxh64_intdigest(w.encode())) for _, t in texts for w in t.split()} | {"": suffixtree._END}
    room = tree.tokens + tree.distinct + 1
    assert tree.distinct == len(names) and room == sum(weight[int(h.view(np.int64))].c + 1 for h in names.values()) + 1
    for context in "xy":
        back = weight[int(names[context].view(np.int64))].w
        assert back < 0
        total = 10 ** back / room  # any token never seen
        for h in names.values():
            pair = suffixtree._mix(names[context][None], h[None]).view(np.int64)[0]
            gain = weight[int(pair)].w if int(pair) in weight else 0.0
            total += 10 ** (back + gain) * (weight[int(h.view(np.int64))].c + 1) / room
        assert total == pytest.approx(1.0)


def test_no_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixtree.op11(empty).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = suffixtree.op11(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert tuple(r) == (held, True, 3, 0, 0, 0.0, 0.0)


def test_pieces_are_whole_texts(monkeypatch):
    monkeypatch.setattr(suffixtree, "PIECE", 10)
    lengths = [3, 4, 1, 25, 1, 1, 9, 2]
    at = np.concatenate([np.arange(n) for n in lengths])
    pieces = [at[x] for x in suffixtree._pieces(at)]
    assert np.concatenate(pieces).tolist() == at.tolist() and all(x[0] == 0 for x in pieces)
    assert len(pieces) == 3 and all(np.nonzero(x == 0)[0][-1] < 10 for x in pieces)
    assert [*suffixtree._pieces(at[:0])] == []


def test_scores_in_pieces_and_only_tables_still_read_stay(spark, monkeypatch):
    monkeypatch.setattr(suffixtree, "PIECE", 16)
    monkeypatch.setattr(suffixtree.score, "__defaults__", (*suffixtree.score.__defaults__[:-1], 30))
    made = []
    whole = suffixtree.tokenised
    monkeypatch.setattr(suffixtree, "tokenised", lambda *a, **b: made.append(whole(*a, **b)) or made[-1])
    rows = rows_of(3)
    got = suffixtree.op11(spark.createDataFrame(rows, "doc_id long, text string, key string, n long"), depth=3, least=3, worth=2.0)
    files = [f.removeprefix("file:").replace("///", "/") for f in made[0].inputFiles()]
    assert len(made) == 1 and files and not any(os.path.exists(f) for f in files)
    want, _ = brute(rows, 3, 3, 2.0)

    def order(r):
        return r[0] is not None, r[0], r[2], r[5]
    for g, w in zip(sorted(map(tuple, got.collect()), key=order), sorted(want, key=order), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-6)
