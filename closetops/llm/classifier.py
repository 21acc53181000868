"""Document quality from statistics of the text.

A Gaussian kernel over standardised statistics is approximated by random
Fourier features.  Ridge regression on them needs only their normal
equations, which are summed for parts of the labelled rows and added up by the driver.
The regression's values are made into probabilities by isotonic regression
on rows kept out of the fit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..operators import stage

#: Labelled rows that the fit reads at most, those of the least hash of the id.
MAX_LABELLED = 20_000
#: Random features, ridge penalty per row, and parts of the labelled rows that are summed to normal equations.
FEATURES, RIDGE, PARTS = 256, 1e-3, 16
SEED = 7

STATISTICS = ("words", "word_length", "word_length_sd", "distinct", "top_word", "same_as_last", "repeated_triples",
              "upper_words", "symbol_words", "upper", "digit", "symbol", "pipe", "exclaim", "stop", "comma",
              "line_words", "dup_lines")


def statistics(text: str | None) -> list[float]:
    """The statistics named in STATISTICS; all 0 for a text without a word."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    size = np.fromiter(map(len, words), np.float64, n)
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = size.sum()
    seen = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [
        np.log1p(n), np.log(size.mean()), size.std() / size.mean(), len(seen) / n ** 0.75, max(seen.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        sum(c for c in triples.values() if c > 1) / n,
        sum(map(bytes.isupper, words)) / n, sum(not x[-1:].isalnum() and x[-1] < 128 for x in words) / n,
        byte[65:91].sum() / chars, byte[48:58].sum() / chars,
        byte[[35, 36, 37, 38, 42, 60, 62]].sum() / n, byte[124] / n, byte[33] / n, byte[46] / n, byte[44] / n,
        np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines)]


@dataclass
class Model:
    """mean, sd: of the statistics; spread, phase: of the features; weights; knots of the calibration."""
    mean: np.ndarray
    sd: np.ndarray
    spread: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -8, 8)
        wave = np.cos(z @ self.spread + self.phase) * np.sqrt(2 / self.spread.shape[1])
        return np.hstack([wave, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.at, self.value)


def isotonic(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (raw value, probability) of the increasing fit by pooling adjacent violators."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of raw values
    for r, y in zip(raw[order], label[order]):
        blocks.append([y, 1, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", bound: int = MAX_LABELLED) -> Model:
    """Fit on at most ``bound`` labelled documents, those with the least hash of the id.

    Null labels are left out; an id with several labels counts with their mean, rounded; an id on several
    rows counts once.  Without any labelled row every score is 0.5.
    """
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.round(F.avg(label_col)).cast("double").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(bound))

    @pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    rows = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                 .join(F.broadcast(chosen), "id")  # at most `bound` rows of 16 bytes
                 .select("id", "label", stats("text").alias("x")).groupBy("id", "label").agg(F.min("x").alias("x"))
                 .withColumn("keep_out", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(5)) == 0))
    k = len(STATISTICS)
    got = rows.agg(F.count("*"), *[F.avg(F.get("x", F.lit(i))) for i in range(k)],
                   *[F.stddev_pop(F.get("x", F.lit(i))) for i in range(k)]).first()
    rng = np.random.default_rng(SEED)
    spread = rng.normal(size=(k, FEATURES)) / np.sqrt(k)
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    mean = np.array([v or 0.0 for v in got[1:k + 1]])
    sd = np.array([v or 1.0 for v in got[k + 1:]])
    model = Model(mean, sd, spread, phase, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))
    if not got[0]:
        return model

    def normal(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("id")
        z = model.features(np.array(p["x"].tolist()))
        return pd.DataFrame({"part": [key[0]], "a": [(z.T @ z).tobytes()],
                             "b": [(z.T @ p["label"].to_numpy()).tobytes()], "n": [len(p)]})

    # PARTS sums of at most `bound` rows together, however many partitions there are
    sums = (rows.where("NOT keep_out").select("id", "x", "label", F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part"))
            .groupBy("part").applyInPandas(normal, "part long, a binary, b binary, n long"))
    a, b, n = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1), 0
    for r in sums.orderBy("part").collect():
        a += np.frombuffer(r.a).reshape(a.shape)
        b += np.frombuffer(r.b)
        n += r.n
    model.weights = np.linalg.solve(a + RIDGE * max(n, 1) * np.eye(len(b)), b)
    kept_out = rows.where("keep_out" if n < got[0] else "true").select("x", "label", "id").orderBy("id").toPandas()
    if len(kept_out):  # a fifth of `bound` rows at most
        model.at, model.value = isotonic(model.raw(np.array(kept_out["x"].tolist())), kept_out["label"].to_numpy())
    return model


def scorer(model: Model):
    """A column function from text to score."""
    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            x = np.array([statistics(t) for t in s]).reshape(len(s), len(STATISTICS))
            yield pd.Series(np.clip(model.score(x), 0, 1))
    return score


def held_out(id_col: str):
    """Rows whose labels the fit never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_in(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(docs, labels.where(~held_out("doc_id")))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, all columns as they are.

    Null and empty texts get the score of a text without words; null ids and repeated rows
    are scored like others; an empty table stays empty.
    """
    score = scorer(fit_in(docs, labels))
    return docs.where(score(F.col("text")) >= 0.5)


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    score = scorer(fit_in(docs, labels))
    return (docs.select("doc_id", held_out("doc_id").alias("held_out"), score(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
