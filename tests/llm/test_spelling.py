"""Spelling variants against a plain version in Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from closetops.llm import spelling

LETTERS = "abcdefghijklmnopqrstuvwxyzàéïöÿÀ"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute(rows, slip=199):
    seen = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            seen[run if h % slip else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: k for w, k in seen.items() if k >= 5 and len(w) >= 6}
    others = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n[w], len(others[w]), n.get(form[w])) for w in n}


def corpus(seed):
    rng = random.Random(seed)
    def one():
        return "".join(rng.choice(LETTERS[:rng.choice([3, 32])]) for _ in range(rng.choice([5, 6, 6, 7, 8, 11, 47, 48, 49, 90])))
    words = [one() for _ in range(60)]
    for w in list(words):
        for _ in range(4):
            i = rng.randrange(len(w))
            words.append(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(LETTERS) + w[i:], w[:i] + rng.choice(LETTERS) + w[i + 1:]]))
    words += ["aaaaaa" + "a" * k for k in range(6)] + ["Xyzzyx", "xyzzyxx", "ÉTÉ" * 3]
    rows = [(i, " ".join(rng.choice([1, 5, 6, 40]) * (rng.choice(words) + rng.choice([" ", "1", "\n"])) for _ in range(60)), "x", 1)
            for i in range(90)]
    return rows + rows[:3] + [(None, rows[0][1], "y", 2), (5, None, "y", 2), (6, "", "y", 2), (7, "q" * 100_000 + (" " + "longer" * 50) * 6, "", 0)]


@pytest.mark.parametrize("seed", [3, 4])
def test_against_a_plain_version(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n long")
    got = [tuple(r) for r in spelling.op13(docs).collect()]
    assert len(got) == len(set(got)) > 100
    assert set(got) == brute(rows)


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 7)
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n long")
    got = {r.word: r.n for r in spelling.runs(docs).where("n >= 5").collect()}
    assert got == {w: n for w, _, _, n, *_ in brute(rows)}


def test_no_words(spark):
    for rows in ([], [(1, None), (None, "a b"), (2, "")]):
        assert spelling.op13(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
