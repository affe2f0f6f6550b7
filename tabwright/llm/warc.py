"""WARC archives: writer with revisit records, and a reader that salvages damaged files.

The writer emits one record per row as bytes of a text sink whose line separator is the
end of a WARC record, so commits, retries and lost executors are the sink's business and
any store Spark can write to will do. The reader checks every record and, where a check
fails, looks for the next version line (or gzip member), goes on from there and reports
the bytes in between.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.common import join_spread
from tabwright.session import fresh_path, materialize

CRLF = "\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
URN = "urn:page:"
# wanted size of an archive, and about what a record takes besides its payload
FILE_BYTES = 32 << 20
HEAD_BYTES = 600


def plan_revisits(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", min_bytes: int = 1000) -> DataFrame:
    """(digest, first, copies) of each payload of at least ``min_bytes`` that occurs more than once.

    ``first`` is the largest id with that payload: its record holds the payload, the others
    point to it.
    """
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    small = pages.select(F.col(id_col).alias("id"), F.sha1(body).alias("digest"), F.octet_length(body).alias("n"))
    held = small.where(F.col("n") >= min_bytes).groupBy("digest")
    return held.agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    min_bytes: int = 1000, records_per_file: int | None = None, file_bytes: int = FILE_BYTES,
) -> None:
    """Write one record per row of ``pages`` below ``path`` (WARC/1.1, uncompressed).

    Null payloads are written as empty ones. Equal payloads of at least ``min_bytes`` are
    stored once, under the largest id; a row that repeats that id is stored again. Rows
    without an id are never the stored copy unless all copies lack one. Control characters
    and blanks in an address are written as %20; a null address leaves its header out.
    Dates are fixed, so that a repeated task writes the same bytes. An archive is the reader's
    unit of work: it holds as many records as make about ``file_bytes`` at the mean payload,
    or ``records_per_file``, if given.
    """
    spark = pages.sparkSession
    if records_per_file is None:
        mean = pages.agg(F.avg(F.octet_length(F.coalesce(F.col(body_col), F.lit(""))))).first()[0] or 0.0
        records_per_file = max(1, int(file_bytes / (mean + HEAD_BYTES)))
    again = materialize(plan_revisits(pages, id_col, body_col, min_bytes), "revisits")
    body = F.coalesce(F.col(body_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(url_col).alias("url"), body.alias("body"),
        F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("n"), F.col(id_col).alias("raw"),
    )
    if again.take(1):
        # ids of revisits only: payloads stay where they are unless there are copies
        ids = materialize(rows.where(F.col("n") >= min_bytes).select("raw", "digest"), "digests")
        hits = join_spread(ids, again, ["digest"], "copies")
        hits = hits.where(~F.col("raw").eqNullSafe(F.col("first"))).select("raw", "digest", "first").distinct()
        hits = materialize(hits, "hits")
        rows = rows.alias("r").join(
            hits.alias("h"), F.col("r.raw").eqNullSafe(F.col("h.raw")) & (F.col("r.digest") == F.col("h.digest")), "left"
        ).select("r.id", "r.url", "r.body", "r.digest", "r.n", F.col("h.first").cast("string").alias("first"))
    else:
        rows = rows.withColumn("first", F.lit(None).cast("string"))
    rows.select(_record().alias("value")).write.option("lineSep", CRLF + CRLF).option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def _record() -> Column:
    """Version line, headers and block of one record; the sink adds the closing blank lines."""
    revisit = F.col("first").isNotNull()
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("body")))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit(f"<{URN}"), F.coalesce("id", F.lit("")), F.lit(">"))),
        F.lit(f"WARC-Date: 2024-01-01T00:00:00Z{CRLF}"),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block.cast("binary")))),
        line("X-Payload-Length", F.col("n").cast("string")),
        F.when(
            revisit,
            F.concat(
                F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}"),
                line("WARC-Refers-To", F.concat(F.lit(f"<{URN}"), F.col("first"), F.lit(">"))),
            ),
        ).otherwise(""),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )


VERSION = re.compile(rb"(?:\A|(?<=\n))WARC/\d+\.\d+\r?\n")
GZIP = b"\x1f\x8b\x08"


class Damaged(ValueError):
    """A record whose block differs from its digest, but ends at ``end`` as its header says."""

    def __init__(self, reason: str, end: int):
        super().__init__(reason)
        self.end = end


def _sha1(label: str) -> str | None:
    """Bare lower-case hex of a labelled SHA-1 in hex or base32; None for any other digest."""
    algorithm, _, digest = label.partition(":")
    if algorithm.lower() != "sha1":
        return None
    try:
        raw = base64.b32decode(digest, casefold=True) if len(digest) == 32 else bytes.fromhex(digest)
    except (ValueError, binascii.Error):
        return None
    return raw.hex() if len(raw) == 20 else None


def _parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``at``; ValueError where a check fails."""
    if not VERSION.match(data, at):
        raise ValueError("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise ValueError("header without end")
    if VERSION.search(data, at + 1, end):
        raise ValueError("header runs into another record")
    head: dict[str, str] = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("header line without colon")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit() or "warc-type" not in head or "warc-record-id" not in head:
        raise ValueError("mandatory header missing")
    start, stop = end + 4, end + 4 + int(head["content-length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("block does not end where it should")
    block = data[start:stop]
    if _sha1(head.get("warc-block-digest", "")) not in (None, hashlib.sha1(block).hexdigest()):
        raise Damaged("block digest differs", stop + 4)
    return head, block, stop + 4


def salvage(data: bytes) -> Iterator[tuple]:
    """("record", start, end, headers, block) and ("gap", start, end, reason) of one archive, in order.

    Gzip archives are read member by member; an unreadable member is passed over up to the
    next magic number that opens a readable one. Offsets are those of the file; of a member
    with several records, all have the member's. Gaps and records cover every byte once.
    """
    if data[:3] == GZIP or (not VERSION.search(data) and GZIP in data):
        yield from _members(data)
        return
    at, lost, why = 0, -1, ""
    while at < len(data):
        try:
            head, block, end = _parse(data, at)
        except ValueError as e:
            if lost < 0:
                lost, why = at, str(e)
            end = e.end if isinstance(e, Damaged) else -1
            if end == len(data) or (end > 0 and VERSION.match(data, end)):
                # the length holds: what looks like a record inside the block is none
                at = end
                continue
            found = VERSION.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if lost >= 0:
            yield ("gap", lost, at, why, b"")
            lost = -1
        yield ("record", at, end, head, block)
        at = end
    if lost >= 0:
        yield ("gap", lost, len(data), why, b"")


def _inflate(data: bytes, at: int, step: int = 1 << 16) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``at``."""
    reader, view, parts = zlib.decompressobj(31), memoryview(data), []
    while not reader.eof:
        if at >= len(data):
            raise ValueError("gzip member without end")
        parts.append(reader.decompress(view[at : at + step]))
        at += step
    return b"".join(parts), min(at, len(data)) - len(reader.unused_data)


def _members(data: bytes) -> Iterator[tuple]:
    at, lost, why = 0, -1, ""
    while at < len(data):
        try:
            if data[at : at + 3] != GZIP:
                raise ValueError("no gzip member")
            plain, end = _inflate(data, at)
            inside = list(salvage(plain))
            if not any(x[0] == "record" for x in inside):
                raise ValueError("gzip member without a record")
        except (ValueError, zlib.error) as e:
            if lost < 0:
                lost, why = at, str(e)
            at = data.find(GZIP, at + 1)
            at = len(data) if at < 0 else at
            continue
        if lost >= 0:
            yield ("gap", lost, at, why, b"")
            lost = -1
        for x in inside:
            yield (x[0], at, end, x[3], x[4])
        at = end
    if lost >= 0:
        yield ("gap", lost, len(data), why, b"")


FIELDS = (
    "file string, start long, end long, kind string, reason string, record_id string, record_type string, "
    "refers_to string, url string, block_bytes long, payload_bytes long, payload_digest string"
)


def _rows(parts: Iterator[pd.DataFrame], keep: bool) -> Iterator[pd.DataFrame]:
    for part in parts:
        for name, data in zip(part["path"], part["content"], strict=True):
            out = []
            for kind, start, end, head, block in salvage(bytes(data)):
                if kind == "gap":
                    out.append((name, start, end, kind, head, *[None] * 7, *[None] * keep))
                    continue
                body = block.partition(b"\r\n\r\n")[2] if head.get("content-type", "").startswith("application/http") else block
                n, digest = len(body), hashlib.sha1(body).hexdigest()
                label = head.get("warc-payload-digest", "")
                said = _sha1(label)
                if head["warc-type"] == "revisit":
                    length = head.get("x-payload-length", "")
                    n, digest = int(length) if length.isdigit() else None, said or label or None
                elif said not in (None, digest):
                    out.append((name, start, end, "gap", "payload digest differs", *[None] * 7, *[None] * keep))
                    continue
                out.append(
                    (
                        name, start, end, kind, None, head["warc-record-id"].strip("<>"), head["warc-type"],
                        head.get("warc-refers-to", "").strip("<>") or None, head.get("warc-target-uri"), len(block), n,
                        digest, *[body] * keep,
                    )
                )
            names = [f.split()[0] for f in FIELDS.split(", ")] + ["payload"] * keep
            yield pd.DataFrame(out, columns=names).astype(
                {c: "Int64" for c in ("start", "end", "block_bytes", "payload_bytes")}
            )


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Records and quarantined gaps of the archives below ``path``: one row each (``kind``).

    Checks: version line, headers, block length and its closing blank lines, block digest,
    payload digest. A record that fails becomes part of a gap with its byte range and the
    first reason; reading goes on at the next version line or gzip member. An empty archive
    gives no rows. With ``payload`` the payload bytes come along (empty for revisits). One
    archive is held in memory at a time.
    SHA-1 digests count in hex and in base32, others are not checked. A record that only differs from
    its block digest is passed over whole, so that records quoted inside it are not taken for real ones.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = FIELDS + (", payload binary" if payload else "")
    return files.mapInPandas(lambda parts: _rows(parts, payload), schema)


def roundtrip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Write ``pages`` as archives and return what the salvage reader finds in them.

    An empty table leaves archives without records and gives no rows.
    """
    path = fresh_path(pages.sparkSession, "warc")
    write_warc(pages, path, id_col, url_col, body_col)
    return read_warc(pages.sparkSession, path)
