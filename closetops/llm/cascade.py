"""Quality rules as a short-circuit cascade.

Rules differ in cost and in how much they reject.  On a bounded sample every
rule is timed and its rejections noted; the cascade then takes, one after the
other, the rule that rejects most of what is left per second.  Over the whole
table a document meets the rules in that order and the first rejection ends
its way.  The order changes what the run costs, never the verdict.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from copy import copy
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Documents on which cost and selectivity are estimated, at most.
SAMPLE = 2000


class Text:
    """A text and what rules ask of it; everything is computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode()
        self.words = self.raw.split()
        self.n_words = len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        if len(w) < 4:
            return 0
        ids: dict[bytes, int] = {}
        code = np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int64, len(w))
        key = (code[:-2] * len(ids) + code[1:-1])
        _, key = np.unique(key, return_inverse=True)
        _, at, n = np.unique(key * len(ids) + code[2:], return_inverse=True, return_counts=True)
        twice = n[at] > 1
        covered = np.zeros(len(w), bool)
        for shift in range(3):
            covered[shift:len(w) - 2 + shift] |= twice
        return int(covered.sum())

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def _upper(t: Text) -> bool:
    letters = np.frombuffer(t.raw, np.uint8)
    upper = int(np.count_nonzero((letters >= 65) & (letters <= 90)))
    return 2 * upper > upper + int(np.count_nonzero((letters >= 97) & (letters <= 122)))


#: What the verdict asks beyond the base: each rejects a document by itself.
RULES = (
    Rule("symbols", lambda t: 4 * t.n_symbols > t.n_words),
    Rule("exclamations", lambda t: 4 * t.raw.count(b"!") > t.n_words),
    Rule("capitals", _upper),
    Rule("short_words", lambda t: t.word_chars < 2 * t.n_words),
    Rule("long_words", lambda t: t.word_chars > 15 * t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("same_word_again", lambda t: 5 * sum(map(bytes.__eq__, t.words, t.words[1:])) > t.n_words),
    Rule("one_word", lambda t: 3 * max(Counter(t.words).values(), default=0) > t.n_words),
    Rule("digits", lambda t: 5 * len(t.raw.translate(None, _NOT_DIGITS)) > 2 * t.word_chars),
)
_NOT_DIGITS = bytes(x for x in range(256) if not 48 <= x <= 57)


#: What is computed of every text, whatever the rules say.
OUTPUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def ordered(docs: DataFrame, text_col: str, rules: Sequence[Rule], sample: int = SAMPLE) -> list[Rule]:
    """The rules by rejection per cost, each given those before it, on at most ``sample`` documents
    that pass the base.  Rules that reject nothing there come last, the cheapest first."""
    n = docs.count()
    if not n or not rules:
        return list(rules)

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for t in map(Text, p[text_col]):
                if t.base_failed:
                    continue
                for name in OUTPUT:
                    getattr(t, name)
                out = []
                for r in rules:
                    fresh = copy(t)  # with what the output needs anyway, and nothing that another rule worked out
                    began = time.perf_counter()
                    out.append((r.rejects(fresh), time.perf_counter() - began))
                yield pd.DataFrame({"rejected": [[bool(x) for x, _ in out]], "seconds": [[s for _, s in out]]})

    got = (docs.select(text_col).sample(fraction=min(1.0, 2 * sample / n), seed=1).limit(sample)
           .mapInPandas(measure, "rejected array<boolean>, seconds array<double>").collect())
    if not got:
        return list(rules)
    rejected, seconds = np.array([r.rejected for r in got]), np.array([r.seconds for r in got])
    left, rest, order = np.ones(len(got), bool), list(range(len(rules))), []
    while rest:
        gain = {i: (rejected[left, i].sum() / max(seconds[left, i].sum(), 1e-9), -seconds[:, i].sum()) for i in rest}
        best = max(rest, key=gain.get)
        order.append(rules[best])
        rest.remove(best)
        left &= ~rejected[:, best]
    return order


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept.

    Null texts are empty: all counts 0, base_failed.  Null ids and repeated rows are judged like
    others; an empty table gives no rows; further columns are ignored.
    """
    order = ordered(docs, text_col, rules)

    @pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                "base_failed boolean, kept boolean")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            rows = []
            for t in map(Text, s):
                kept = not t.base_failed and not any(r.rejects(t) for r in order)  # any() stops at the first
                rows.append((*(getattr(t, n) for n in OUTPUT), kept))
            yield pd.DataFrame(rows, columns=[*OUTPUT, "kept"])

    return docs.select(F.col(id_col).alias("id"), judge(F.col(text_col)).alias("j")).select("id", "j.*")


def op4(docs: DataFrame) -> DataFrame:
    return judged(docs).withColumnRenamed("id", "doc_id")
