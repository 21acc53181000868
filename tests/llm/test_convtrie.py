"""The conversation trie against a plain trie in Python."""

import hashlib
import random
import re
import zlib

import pytest

from closetops.llm import convtrie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, part string, a long, conv string"


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(abs(c) % 20 * (1 if c >= 0 else -1))
        full[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = {}
    for c, v in full.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
    def words(x):
        return len(re.findall(r"[^\x20\x09-\x0D]+", x))
    children = {n: [m for m in members if len(m) == len(n) + 1 and m[:-1] == n] for n in members}
    out = []
    for n, m in members.items():
        below = [x for x in members if x[:len(n)] == n]
        ends = ",".join(map(str, sorted(c for c in m if len(full[c]) == len(n))))
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]),
                    sum(not children[x] for x in below),
                    sum((len(members[x]) - 1) * words(x[-1][1]) for x in below if x),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def found(spark, rows, monkeypatch=None):
    df = spark.createDataFrame([(*r, 1, "p", 2, "c") for r in rows], SCHEMA)
    got = [tuple(r) for r in convtrie.op12(df).collect()]
    return sorted(got, key=lambda r: tuple((x is not None, x) for x in r))


def rows_of(seed, n=60):
    rng = random.Random(seed)
    say = [("user", "a b c"), ("user", "a  b"), (None, ""), ("assistant", None), ("user", "x" * 5000), ("", "é ü ß")]
    rows = []
    for c in [*range(n), *range(-25, -18), 40, 10 ** 12, 10 ** 12 + 7]:
        for t in range(rng.choice([1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([t, t, t, None, 2]), *rng.choice(say[:3 if c % 3 else 6])))
    return rows + rows[:5] + [(None, 1, "user", "lost"), (7, None, None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_trie(spark, seed):
    rows = rows_of(seed)
    random.Random(seed).shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_many_parts_and_hot_nodes(spark, monkeypatch):
    """Long conversations and long end lists cut over partitions; parents joined apart."""
    monkeypatch.setattr(convtrie, "HOT_CHILDREN", 2)
    rows = [(c, t, "user", f"t{t % 7}") for c in (40, 45, 61) for t in range(90)]
    rows += [(c, t, "user", "same") for c in range(100, 400) for t in range(5)]
    rows += [(c, t, "user", f"{t and c}") for c in range(500, 560) for t in range(5)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
