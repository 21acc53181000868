"""WARC archives: written as responses, revisits and segments, read back whole.

Writing: equal payloads are found by digest; one response per payload, revisit
records for the others.  A response's payload goes in chunked transfer framing,
and a block longer than a segment is cut into a first record and continuation
records.  Spark's text writer stores the records, with the WARC record end as
its line end, in gzip files of a folder that all executors share.

Reading: Spark's text reader streams the archives cut at the version line.  A
payload may hold that line too, so each record is completed to the length its
header states.  Records without segments are decoded at once; segments are
grouped by the identifier of their origin, put in order of segment number, and
checked against the total length before the chunks are decoded.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..operators import _fs, stage
from ..session import ensure_checkpoint_dir

VERSION, END = b"WARC/1.1\r\n", b"\r\n\r\n"
#: Bytes of a record's block before it is cut, of an HTTP chunk, and the least payload that is deduplicated.
SEGMENT_BYTES, CHUNK_BYTES, DEDUP_BYTES = 16_384, 8192, 100
DATE = "2024-01-01T00:00:00Z"


def record_id(*what) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(repr(what).encode()).hexdigest())}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        size = int(body[at:eol].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if body[eol + 2 + size:eol + 4 + size] != b"\r\n":
            raise ValueError("chunk length")
        out.append(body[eol + 2:eol + 2 + size])
        at = eol + 4 + size


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return VERSION + head.encode() + b"\r\n" + block


def records(page: str | None, url: str | None, payload: bytes, digest: str, first: str | None,
            segment: int) -> list[bytes]:
    """The records of one page, without their ends.  first: the page that has the response, if another one has it."""
    name = record_id(page, digest)
    url = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    common = [("WARC-Date", DATE), ("WARC-Target-URI", url), ("X-Page-ID", page or ""),
              ("WARC-Payload-Digest", f"sha256:{digest}")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is not None:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload)
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common,
                         ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                         ("WARC-Refers-To", record_id(first, digest)), ("X-Refers-To-Page-ID", first),
                         ("Content-Type", "application/http; msgtype=response")], block)]
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    kind = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common,
            ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= segment:
        return [_record(kind, block)]
    cuts = [block[i:i + segment] for i in range(0, len(block), segment)]
    out = [_record([*kind, ("WARC-Segment-Number", 1)], cuts[0])]
    for n, cut in enumerate(cuts[1:], 2):
        last = [("WARC-Segment-Total-Length", len(block))] if n == len(cuts) else []
        out.append(_record([("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page, digest, n)),
                            ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", name),
                            ("WARC-Segment-Number", n), *last], cut))
    return out


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               segment: int = SEGMENT_BYTES, least: int = DEDUP_BYTES) -> None:
    """Write one response or revisit record for each row to gzip archives in ``path``.

    Of rows with equal payloads of at least ``least`` bytes, those with the least id are responses
    (repeated rows with that id too), the others revisits; where all ids are null, all are responses.
    Null html is an empty payload, a null url an empty target.
    """
    narrow = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    firsts = stage(narrow.where(F.octet_length("html") >= least)
                   .groupBy(F.sha2(F.col("html").cast("binary"), 256).alias("sha"))
                   .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
                   .drop("n"))
    rows = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                         F.coalesce(F.col(html_col), F.lit("")).alias("html"))
            .withColumn("payload", F.col("html").cast("binary"))
            .withColumn("sha", F.sha2("payload", 256)).drop("html").join(firsts, "sha", "left"))

    @pandas_udf("array<binary>")
    def framed(page: pd.Series, url: pd.Series, payload: pd.Series, sha: pd.Series, refers: pd.Series) -> pd.Series:
        return pd.Series([records(*r, segment) for r in zip(page, url, payload, sha, refers)])

    # ids travel as text: a column of integers and nulls would reach pandas as floats
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    out = rows.select(F.explode(framed(F.col("id").cast("string"), "url", "payload", "sha", refers.cast("string"))).alias("r"))
    out.select(F.col("r").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


_SCHEMA = ("record_id string, type string, target string, page string, digest string, refers string, "
           "refers_page string, origin string, segment long, total long, block binary")


def _parsed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records from pieces of archives cut at the version line, in file order."""
    pending, rows = None, []  # header bytes, block so far, length it must have

    def row(head: bytes, block: bytes):
        h = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n"))}
        number = h.get("warc-segment-number")
        return (h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"), h.get("x-page-id"),
                h.get("warc-payload-digest"), h.get("warc-refers-to"), h.get("x-refers-to-page-id"),
                h.get("warc-segment-origin-id", h.get("warc-record-id") if number else None),
                int(number) if number else None,
                int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, block)

    columns = [x.split()[0] for x in _SCHEMA.split(", ")]

    def table(rows):
        out = pd.DataFrame(rows, columns=columns)
        return out.astype({"segment": "Int64", "total": "Int64"})

    for p in parts:
        for piece in p["value"]:
            if pending is None:
                head, gap, block = piece.partition(b"\r\n\r\n")
                if not gap:  # before the first record
                    continue
                length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                pending = [head, [block], len(block), length]
            else:  # the version line stood inside the block
                pending[1] += [VERSION, piece]
                pending[2] += len(VERSION) + len(piece)
            if pending[2] >= pending[3]:
                rows.append(row(pending[0], b"".join(pending[1])[:pending[3]]))
                pending = None
            if len(rows) >= 500:
                yield table(rows)
                rows = []
    if pending is not None:
        raise ValueError("an archive ends inside a record")
    yield table(rows)


def read_warc(spark, path: str) -> DataFrame:
    """One row per response or revisit record: record_id, type, target, page, digest, refers,
    refers_page, payload (of revisits null), length (of the payload; of revisits as stated).

    Archives are read whole; a record whose segments are missing or have another total length than
    stated, or whose chunks are broken, raises an error.  Sets of segments that occur repeatedly
    (repeated rows when writing) give their record as often.
    """
    pieces = spark.read.option("lineSep", VERSION.decode()).text(path).select(F.col("value").cast("binary"))
    parsed = pieces.mapInPandas(_parsed, _SCHEMA)
    parsed = stage(parsed)  # read by both branches
    names = [c for c in parsed.columns if c not in ("origin", "segment", "total", "block")]
    first = F.col("segment") == 1
    whole = parsed.where("origin IS NULL").select(*names, F.lit(1).cast("long").alias("copies"), F.array("block").alias("blocks"),
                                                  F.lit(None).cast("long").alias("total"))
    segments = (parsed.where("origin IS NOT NULL").groupBy("origin", "segment")  # equal segments of repeated rows: once
                .agg(F.max("block").alias("block"), F.count("*").alias("copies"), F.max("total").alias("total"),
                     *[F.max(F.when(first, F.col(c))).alias(c) for c in names])
                .groupBy("origin")
                .agg(*[F.max(c).alias(c) for c in names], F.max(F.when(first, F.col("copies"))).alias("copies"),
                     F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
                     F.coalesce(F.max("total"), F.lit(-1).cast("long")).alias("total"))
                .select(*names, "copies", F.col("parts.block").alias("blocks"), "total"))

    @pandas_udf("payload binary, length long")
    def decoded(kind: pd.Series, blocks: pd.Series, total: pd.Series) -> pd.DataFrame:
        payloads, lengths = [], []
        for k, b, n in zip(kind, blocks, total):
            b = b"".join(b)
            if not pd.isna(n) and n != len(b):
                raise ValueError(f"segments hold {len(b)} bytes; stated: {n:.0f}")
            head, _, body = b.partition(b"\r\n\r\n")
            http = {x.split(b":")[0].strip().lower(): x.partition(b":")[2].strip() for x in head.split(b"\r\n")[1:]}
            if k == "revisit":
                body = None
            elif http.get(b"transfer-encoding", b"").lower() == b"chunked":
                body = dechunked(body)
            payloads.append(body)
            lengths.append(int(http[b"content-length"]) if body is None else len(body))
        return pd.DataFrame({"payload": payloads, "length": lengths})

    return (whole.unionByName(segments).where("type IN ('response', 'revisit')")
            .withColumn("d", decoded("type", "blocks", "total"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select(*names, "d.*"))


def scratch(spark) -> str:
    """A new folder for archives in the shared checkpoint folder, deleted when the session ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    fs, where = _fs(spark, path)
    fs.deleteOnExit(where)
    return path


def op3(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Null ids, repeated rows, empty payloads and an empty table: see :func:`write_warc` and :func:`read_warc`."""
    path = path or scratch(pages.sparkSession)
    write_warc(pages, path)
    got = read_warc(pages.sparkSession, path)
    digest = F.when(F.col("type") == "revisit", F.element_at(F.split("digest", ":"), 2)).otherwise(F.sha2("payload", 256))
    return got.select(F.expr("try_cast(nullif(page, '') AS bigint)").alias("page_id"), F.col("length").alias("payload_bytes"),
                      digest.alias("payload_digest"), F.col("type").alias("record_type"),
                      F.expr("try_cast(refers_page AS bigint)").alias("refers_to"))
