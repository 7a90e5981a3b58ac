"""WARC archives through Spark's own writers and readers, with segmented records.

A record is text: its header, an empty line and its block. The block of a response is an HTTP
message in chunked transfer framing; a long one is cut into a first segment and continuation
records, which may stand in other files. Spark's text writer puts the end of a record, two line
ends, after each, so the files are plain WARC files, written with Spark's commit protocol to any
file system. Reading groups continuation records by their origin, orders them by segment number,
checks the total length and takes the chunked framing away.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, saved, shared_path

END = "\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END


def cut_points(data: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Pieces of at most ``size`` bytes that end at a character's end."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        yield at, end
        at = end


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in chunked transfer framing, with a last chunk of no bytes."""
    parts = [b"%x\r\n%b\r\n" % (b - a, payload[a:b]) for a, b in cut_points(payload, size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None where the framing is broken."""
    out, at = [], 0
    while True:
        eol = body.find(b"\r\n", at)
        if eol < 0:
            return None
        try:
            n = int(body[at:eol].split(b";")[0], 16)
        except ValueError:
            return None
        at = eol + 2
        if not n:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def header(fields: dict) -> str:
    """A record's header with its empty line; fields without a value are left out."""
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    return "WARC/1.1\r\n" + "\r\n".join(lines) + END


def _one_line(value: str) -> str:
    """The value with control characters and spaces percent-encoded, as a header field needs."""
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in value)


def records(
    page_id, url, html: str, refers_to, digest: str, chunk: int, segment: int
) -> Iterator[str]:
    """The records of one page: a revisit, or a response and its continuations.

    Ids are made of page_id and digest, so a revisit names the id of the response that it refers to. A
    page_id stands percent-encoded, with ``=`` before it; a null one is empty.
    """
    page_id, refers_to = (None if i is None else "=" + quote(str(i), safe="") for i in (page_id, refers_to))
    page_id = page_id or ""
    fields = {
        "WARC-Record-ID": f"<urn:page:{page_id}:{digest}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": _one_line(url) if url else f"urn:page:{page_id}",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
    }
    if refers_to is not None:
        revisit = {
            "WARC-Type": "revisit",
            **fields,
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": f"<urn:page:{refers_to}:{digest}>",
            "Content-Type": "application/http;msgtype=response",
            "Content-Length": len(_HTTP),
        }
        yield header(revisit) + _HTTP
        return
    block = _HTTP.encode() + chunked(html.encode(), chunk)
    pieces = list(cut_points(block, segment))
    for k, (a, b) in enumerate(pieces, 1):
        last = len(pieces) > 1 and k == len(pieces)
        own = fields if k == 1 else {**fields, "WARC-Record-ID": f"<urn:page:{page_id}:{digest}:{k}>"}
        yield header(
            {
                "WARC-Type": "response" if k == 1 else "continuation",
                **own,
                "WARC-Segment-Number": k if len(pieces) > 1 else None,
                "WARC-Segment-Origin-ID": fields["WARC-Record-ID"] if k > 1 else None,
                "WARC-Segment-Total-Length": len(block) if last else None,
                "Content-Type": "application/http;msgtype=response" if k == 1 else None,
                "Content-Length": b - a,
            }
        ) + block[a:b].decode()


def with_originals(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, url, html, digest, keep): keep is the largest page_id of an equal payload.

    Payloads below ``min_bytes`` have none. Keys are combined in each task before the shuffle. A payload of
    more than a thousandth of all copies is hot; there are fewer than a thousand, which go to all tasks, so
    the pages of one don't meet.
    """
    html = F.coalesce("html", F.lit(""))
    raw = F.encode(html, "UTF-8")
    rows = pages.select(
        "page_id", "url", html.alias("html"), F.sha1(raw).alias("digest"), F.sha2(raw, 256).alias("same"),
        F.octet_length(html).alias("n"),
    )
    best = saved(
        rows.filter(F.col("n") >= min_bytes).groupBy("same").agg(F.max("page_id").alias("keep"), F.count("*").alias("copies"))
        .filter(F.col("copies") > 1), "originals"
    )
    limit = (best.agg(F.sum("copies")).first()[0] or 0) / 1000
    hot = best.filter(F.col("copies") > limit).select("same", F.col("keep").alias("hot"))
    rest = best.filter(F.col("copies") <= limit).select(F.col("same").alias("of"), F.col("keep").alias("rest"))
    rows = rows.join(F.broadcast(hot), "same", "left")
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))  # no payload has that digest
    rows = rows.withColumn("at", F.when(F.col("hot").isNull(), F.col("same")).otherwise(alone))
    return rows.join(rest, F.col("at") == F.col("of"), "left").withColumn("keep", F.coalesce("hot", "rest")).drop("hot", "rest", "of", "at")


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 1000, chunk: int = 8192, segment: int = 1 << 16, per_file: int = 2_000
) -> None:
    """Writes the records of ``pages`` as gzip-packed WARC files of at most ``per_file`` records."""
    revisit = F.col("keep").isNotNull() & F.col("page_id").isNotNull() & (F.col("keep") != F.col("page_id"))
    rows = with_originals(pages, min_bytes).select(
        "page_id", "url", F.when(revisit, F.lit(None)).otherwise(F.col("html")).alias("html"),
        F.when(revisit, F.col("keep")).alias("keep"), "digest",
    )

    def run(batches):
        schema = pa.schema([("value", pa.string())])
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                yield batch({"value": list(records(*r, chunk, segment))}, schema)

    text = rows.mapInArrow(run, "value string")
    text.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


_READ = pa.schema(
    [("id", pa.string()), ("kind", pa.string()), ("digest", pa.string()), ("refers", pa.string()), ("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("block", pa.binary())]
)


def page_of(record_id: str | None) -> str | None:
    """The page_id, as text, in a record id; None for a null one."""
    part = record_id.removesuffix(">").split(":")[2] if record_id else ""
    return unquote(part[1:]) if part else None


def parse(data: bytes) -> Iterator[dict]:
    """The records of an unpacked archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:stop].decode().split("\r\n")[1:])
        start, n = stop + 4, int(fields["Content-Length"])
        at = start + n + 4
        digest = fields.get("WARC-Payload-Digest")
        yield {
            "id": fields["WARC-Record-ID"],
            "kind": fields["WARC-Type"],
            "digest": base64.b32decode(digest[5:]).hex() if digest else None,
            "refers": fields.get("WARC-Refers-To"),
            "origin": fields.get("WARC-Segment-Origin-ID"),
            "number": int(fields.get("WARC-Segment-Number", 0)),
            "total": int(fields.get("WARC-Segment-Total-Length", 0)),
            "block": data[start : start + n],
        }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives at ``path``; a file is unpacked in one task."""

    def run(batches):
        for b in batches:
            for content in b.column(0).to_pylist():
                rows = []
                for r in parse(zlib.decompress(content, 47) if content else b""):
                    rows.append(r)
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, _READ)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(
        run, "id string, kind string, digest string, refers string, origin string, number long, total long, block binary"
    )


def reassembled(found: DataFrame) -> DataFrame:
    """Whole records: (id, kind, digest, refers, block, complete).

    Segments meet by the id of their origin, in order of their number; a record is complete if
    none is missing and their lengths sum up to the total that the last one gives. Records of one id
    are equal (rows that repeat); there are as many whole ones as of each segment.
    """
    whole = found.filter("number = 0").select("id", "kind", "digest", "refers", "block", F.lit(True).alias("complete"))
    parts = F.array_sort(F.collect_set(F.struct("number", "total", "block", "kind", "digest")))
    joined = found.filter("number > 0").groupBy(F.coalesce("origin", "id").alias("id")).agg(parts.alias("p"), F.count("*").alias("n"))
    size = F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x["block"]))
    numbers = F.transform("p", lambda x: x["number"])
    complete = (numbers == F.sequence(F.lit(1).cast("long"), F.size("p").cast("long"))) & (
        F.element_at("p", -1)["total"] == size
    )
    block = F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["block"])), ""))
    return whole.unionByName(
        joined.select(
            "id", F.explode(F.array_repeat(block, F.ceil(F.col("n") / F.size("p")).cast("int"))).alias("block"), F.col("p")[0]["kind"].alias("kind"), F.col("p")[0]["digest"].alias("digest"),
            F.lit(None).cast("string").alias("refers"), complete.alias("complete"),
        )
    )


def payloads(whole: DataFrame) -> DataFrame:
    """(page, kind, digest, refers, payload, valid) of whole records, the framing taken away.

    ``valid``: complete, framed well, and (for responses) of the digest that the header gives.
    """

    def run(batches):
        schema = pa.schema([("page", pa.string()), ("kind", pa.string()), ("digest", pa.string()), ("refers", pa.string()), ("payload", pa.binary()), ("valid", pa.bool_())])
        for b in batches:
            rows = []
            for r in b.to_pylist():
                response, payload = r["kind"] == "response", None
                if response and r["complete"]:
                    payload = dechunked(r["block"][r["block"].index(b"\r\n\r\n") + 4 :])
                valid = not response or payload is not None and hashlib.sha1(payload).hexdigest() == r["digest"]
                rows.append(
                    {"page": page_of(r["id"]), "kind": r["kind"], "digest": r["digest"], "payload": payload, "valid": valid,
                     "refers": page_of(r["refers"])}
                )
            yield pa.RecordBatch.from_pylist(rows, schema)

    return whole.mapInArrow(run, "page string, kind string, digest string, refers string, payload binary, valid boolean")


def archive_round_trip(pages: DataFrame, min_bytes: int = 1000, path: str | None = None, **options) -> DataFrame:
    """Writes ``pages`` as archives, reads them back, and gives one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to and valid. Of equal payloads of
    at least ``min_bytes`` bytes that of the largest page_id is the response, the others revisit it
    and get length and digest from the record that they refer to. A null html is an empty payload;
    a null url becomes a urn; a page with a null page_id is always a response. Rows that repeat the
    page_id of the response are responses too. Payloads of any length count as a whole. An empty table
    gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path, min_bytes, **options)
    found = payloads(reassembled(read_records(spark, path)))
    rows = saved(found.select("page", "kind", "digest", "refers", "valid", F.octet_length("payload").alias("n")), "records")
    revisits, responses = (rows.filter(F.col("kind") == k) for k in ("revisit", "response"))
    asked = saved(revisits.groupBy("refers").agg(F.count("*").alias("asked")), "asked")
    targets = responses.drop("refers").withColumnRenamed("page", "of").join(asked, F.col("of") == F.col("refers")).groupBy("of", "asked")
    targets = targets.agg(F.max(F.struct("n", "digest", "valid")).alias("target"))
    # A response with more than a thousandth of all revisits is hot; there are fewer than a thousand.
    limit = (asked.agg(F.sum("asked")).first()[0] or 0) / 1000
    hot = targets.filter(F.col("asked") > limit).select("of", F.col("target").alias("hot"))
    rest = targets.filter(F.col("asked") <= limit).select(F.col("of").alias("rest_of"), F.col("target").alias("rest"))
    revisits = revisits.join(F.broadcast(hot), F.col("refers") == F.col("of"), "left")
    at = F.when(F.col("hot").isNull(), F.col("refers")).otherwise(F.concat(F.lit("-"), F.coalesce("page", F.lit(""))))  # a minus before a page's own name isn't looked up
    revisits = revisits.withColumn("at", at).join(rest, F.col("at") == F.col("rest_of"), "left").withColumn("target", F.coalesce("hot", "rest"))
    revisits = revisits.select(
        "page", "kind", "refers", F.col("target.n").alias("n"), F.col("target.digest").alias("digest"),
        (F.coalesce(F.col("target.valid"), F.lit(False)) & F.coalesce(F.col("target.digest") == F.col("digest"), F.lit(False))).alias("valid"),
    )
    joined = responses.select(revisits.columns).unionByName(revisits)
    kind = pages.schema["page_id"].dataType
    return joined.select(
        F.col("page").cast(kind).alias("page_id"),
        F.col("n").cast("long").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").cast(kind).alias("refers_to"),
        "valid",
    )
