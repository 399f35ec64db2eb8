"""WARC archives: records written as segments, and put together again when read.

A payload that was stored before becomes a revisit of the record that holds it. A response is an HTTP
message with chunked framing; one longer than a segment goes on in continuation records. Reading
groups the segments by origin, orders them by number, verifies the total length, takes off the
chunked framing and verifies the payload's digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm.runtime import Scratch, map_batches
from martloom.session import scratch_path

VERSION = b"WARC/1.1"
BREAK = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "origin string, number int, total bigint, page_id bigint, record_type string, refers_to bigint, "
    "payload_digest string, payload_bytes bigint, block binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without the two line ends that follow it."""
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in headers if v is not None], f"Content-Length: {len(block)}".encode()]
    return BREAK.join(lines) + BREAK + BREAK + block


def chunked(payload: bytes, size: int) -> bytes:
    """Payload in chunks of at most ``size`` bytes with the closing empty chunk."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a chunked body; raises if a chunk is cut off."""
    parts, at = [], 0
    while True:
        stop = body.index(BREAK, at)
        size = int(body[at:stop].split(b";")[0], 16)
        at = stop + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != BREAK:
            raise ValueError("a chunk does not end where its length says")
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(message: bytes) -> bytes:
    """Payload of an HTTP message."""
    head, _, body = message.partition(BREAK + BREAK)
    fields = dict(line.lower().split(b": ", 1) for line in head.split(BREAK)[1:] if b": " in line)
    return unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def page_records(
    page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None,
    segment_bytes: int, chunk_bytes: int,
) -> Iterator[bytes]:
    """Records of one page: a revisit, or a response and its continuations."""
    origin = f"<urn:page:{page_id}:{digest}>"
    target = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n".encode()
    common = [("WARC-Record-ID", origin), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if payload is None:
        original = f"<urn:page:{refers_to}:{digest}>"
        yield record(
            [("WARC-Type", "revisit"), *common, ("WARC-Refers-To", original), ("WARC-Profile", REVISIT_PROFILE),
             ("WARC-Payload-Length", size)],
            head,
        )
        return
    message = head + chunked(payload, chunk_bytes)
    parts = [message[i : i + segment_bytes] for i in range(0, len(message), segment_bytes)]
    for number, part in enumerate(parts, 1):
        segment = [] if len(parts) == 1 else [("WARC-Segment-Number", number)]
        if number > 1:
            ids = [("WARC-Record-ID", f"{origin[:-1]}:{number}>"), ("WARC-Segment-Origin-ID", origin)]
            total = [("WARC-Segment-Total-Length", len(message))] if number == len(parts) else []
            yield record([("WARC-Type", "continuation"), *ids, *segment, *total], part)
        else:
            yield record([("WARC-Type", "response"), *common, *segment], part)


def write_archives(
    pages: DataFrame, path: str, segment_bytes: int = 16_384, chunk_bytes: int = 4_096, records_per_file: int = 256,
    least_revisit_bytes: int = 0, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
) -> None:
    """Write the pages as gzip archives below ``path``, each file at most ``records_per_file`` segments long.

    Of pages with equal payloads of at least ``least_revisit_bytes`` the one with the smallest id is
    the response. Null html is an empty payload, a null url leaves the header out, rows with equal
    id and payload are one record, and a null id counts as the largest.
    """
    payload = F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload")
    ).withColumn("hex", F.sha1("payload"))
    digests = rows.select("page_id", "hex", F.octet_length("payload").cast("bigint").alias("size")).distinct()
    scratch = Scratch(pages.sparkSession)
    firsts = scratch.keep(digests.groupBy("hex").agg(F.min("page_id").alias("first")), "first-pages")
    told = digests.join(firsts, "hex").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("size") >= least_revisit_bytes), F.col("first"))
    )
    one = rows.join(
        told.select(F.col("hex").alias("h"), F.col("page_id").alias("p"), "size", "refers_to"),
        (F.col("hex") == F.col("h")) & F.col("page_id").eqNullSafe(F.col("p")),
    ).select(
        "page_id", "url", "hex", "size", "refers_to", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload")
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for page_id, url, code, size, refers_to, body in zip(*[c.to_pylist() for c in batch.columns]):
            digest = base64.b32encode(bytes.fromhex(code)).decode()
            out += page_records(page_id, url, body, digest, size, refers_to, segment_bytes, chunk_bytes)
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = map_batches(one, run, "record binary")
    # cast leaves the bytes as they are, and the text writer puts the two line ends behind each record
    (
        records.select(F.col("record").cast("string"))
        .write.option("lineSep", "\r\n\r\n")
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", "gzip")
        .text(path)
    )
    scratch.drop("first-pages")


def parse(archive: bytes) -> Iterator[dict]:
    """Records of one archive as rows; what is complete is decoded and checked, segments keep their block."""
    at = 0
    while at < len(archive):
        stop = archive.index(BREAK + BREAK, at)
        lines = archive[at:stop].decode().split("\r\n")
        if lines[0].encode() != VERSION:
            raise ValueError(f"no record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        at = stop + 4
        block = archive[at : at + int(head["Content-Length"])]
        at += len(block)
        if archive[at : at + 4] != BREAK + BREAK:
            raise ValueError(f"a record does not end at byte {at}")
        at += 4
        kind = head["WARC-Type"]
        origin = head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"])
        page = origin[1:-1].split(":")[2]
        row = {
            "origin": origin, "number": int(head.get("WARC-Segment-Number", 1)),
            "total": int(head["WARC-Segment-Total-Length"]) if "WARC-Segment-Total-Length" in head else None,
            "page_id": None if page == "None" else int(page), "record_type": kind, "refers_to": None,
            "payload_digest": head.get("WARC-Payload-Digest", "")[5:] or None, "payload_bytes": None, "block": None,
        }
        if kind == "revisit":
            row["refers_to"] = int(head["WARC-Refers-To"][1:-1].split(":")[2])
            row["payload_bytes"] = int(head["WARC-Payload-Length"])
        elif "WARC-Segment-Number" in head:
            row["block"] = block
        else:
            row["payload_bytes"] = checked(payload_of(block), row["payload_digest"])
        yield row


def checked(payload: bytes, digest: str) -> int:
    """Length of the payload; raises if its digest is another."""
    if base32_sha1(payload) != digest:
        raise ValueError(f"payload does not have the digest {digest}")
    return len(payload)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Segments may stand in any order and in any file. A missing segment, a length or a digest that
    does not fit fails the job. A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    fields = RECORD.split(", ")
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in fields)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [r for content in batch.column(0) for r in parse(gzip.decompress(content.as_py()))]
        return pa.RecordBatch.from_pylist(rows, schema)

    records = map_batches(files, run, RECORD)
    whole = records.groupBy("origin").agg(
        F.sort_array(F.collect_set(F.struct("number", "total", "block"))).alias("segments"),
        *[F.max(c).alias(c) for c in ("page_id", "refers_to", "payload_digest", "payload_bytes")],
        F.max(F.when(F.col("number") == 1, F.col("record_type"))).alias("record_type"),
    )

    def reassemble(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        sizes = []
        for segments, digest, size in zip(columns["segments"], columns["payload_digest"], columns["payload_bytes"]):
            if size is None:
                message = b"".join(s["block"] for s in segments)
                if [s["number"] for s in segments] != list(range(1, len(segments) + 1)) or segments[-1]["total"] != len(message):
                    raise ValueError(f"segments of {digest} are not complete")
                size = checked(payload_of(message), digest)
            sizes.append(size)
        arrays = [batch.column("page_id"), pa.array(sizes, pa.int64())] + [
            batch.column(n) for n in ("payload_digest", "record_type", "refers_to")
        ]
        return pa.RecordBatch.from_arrays(arrays, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return map_batches(
        whole, reassemble, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm-warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archives(spark, path)


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v{i} // {32 ** (3 - j)}) % 32 + 1, 1)" for i in range(8) for j in range(4)
)
_FIVES = ", ".join(f"('0x' || substr(h, {5 * i + 1}, 5))::BIGINT AS v{i}" for i in range(8))
ORACLE = f"""
WITH hashed AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
           sha1(coalesce(html, '')) AS h
    FROM pages
), firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first, {_FIVES} FROM hashed)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""
