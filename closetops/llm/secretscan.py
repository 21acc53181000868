"""Secrets in texts: three patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary spends few tokens on what it has seen often.  Strings
of random characters need a token for every one or two of them, words and
names one for three or more.  Runs of key-like characters with a low ratio of
characters to tokens are reported, unless they are digests of a known length
or identifiers.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Runs that are tested, their least length, and the characters per token below which one counts as random.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
RATIO = 1.9
#: Lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
DIGEST = re.compile("|".join(f"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in DIGESTS))
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Stretches of a run between its marks.
STRETCH = re.compile(r"[A-Za-z0-9]{16,}")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def is_identifier(run: str, n_tokens, ratio: float = RATIO) -> bool:
    """Numbers, and names of words and numbers in camel case or joined by marks: parts of three characters or more on
    average, and each part of letters one token or with as many characters per token as a run that isn't random."""
    parts = PART.findall(run)
    letters = [p for p in parts if not p.isdigit()]
    return not letters or (sum(map(len, parts)) >= 3 * len(parts) and max(map(len, letters)) >= 4
                           and sum(p.isdigit() for p in parts) <= 2
                           and all((n := n_tokens(p)) == 1 or len(p) >= ratio * n for p in letters))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if any(map(text.lower().__contains__, KEYWORDS)):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def is_random(run: str, n_tokens, ratio: float = RATIO) -> bool:
    """Few characters per token, and no number, digest or identifier."""
    return not (run.isdigit() or DIGEST.fullmatch(run) or UUID.fullmatch(run)) and (
        len(run) < ratio * n_tokens(run) and not is_identifier(run, n_tokens, ratio))


def random_spans(text: str, n_tokens, taken: list[tuple[str, int, int]], ratio: float = RATIO) -> list[tuple[str, int, int]]:
    """Random runs, and random stretches between the marks of other runs (a path or a name before a
    key must not hide it), that touch no span in ``taken``."""
    out = []
    for m in RUN.finditer(text):
        run, a, b = m[0], m.start(), m.end()
        if UUID.fullmatch(run):
            continue
        if not any(x < b and a < y for _, x, y in taken) and is_random(run, n_tokens, ratio):
            out.append(("random", a, b))
            continue
        for s in STRETCH.finditer(run):
            x, y = a + s.start(), a + s.end()
            if s[0] != run and not any(i < y and x < j for _, i, j in taken) and is_random(s[0], n_tokens, ratio):
                out.append(("random", x, y))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def encoder(vocabulary: str):
    """Function from a string to its number of tokens."""
    import tiktoken
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    return lambda s: len(encoding.encode_ordinary(s))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
         ratio: float = RATIO) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, n_random, base_sha256, spans (code points,
    end exclusive).

    The vocabulary file must be readable on every executor.  Null and empty texts have no spans (the
    digest is that of the empty string); null ids and repeated rows are scanned like others; an
    empty table gives no rows; further columns are ignored.
    """
    @pandas_udf("n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        n_tokens = encoder(vocabulary)
        for s in parts:
            rows = []
            for t in s:
                t = t or ""
                base = base_spans(t)
                more = random_spans(t, n_tokens, base, ratio)
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]), len(more),
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    return docs.select(F.col(id_col).alias("id"), find(F.col(text_col)).alias("f")).select("id", "f.*")


def op10(docs: DataFrame) -> DataFrame:
    return scan(docs).select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
