"""Web archives (WARC 1.1): pages are written as segmented records, read back and put together again.

A page is an HTTP response with a chunked body. A record longer than `SEGMENT` bytes is cut: the first piece is the `response`
record with segment number 1, the others are `continuation` records that name it as their origin, the last of them with the total
length. A reader finishes whole records where it reads them; pieces are grouped by their origin, ordered by number, checked
against the total length, and only then is the chunked body decoded.

Equal payloads of `LEAST` bytes or more are stored once: the record with the largest key is the response, the others are
`revisit` records without a body that refer to it.

An archive is a file of records, each a gzip member of its own, with an empty member after it (that is what Spark's text
writer puts between values). Archives are cut after `PER_ARCHIVE` records, and a file is read by one task.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.common import perhaps_in
from assayer.scratch import new_path, written

LEAST = 1000  # bytes of a payload that is stored once
SEGMENT = 16_384  # bytes of a record's block
CHUNK = 4096  # bytes of a chunk of an HTTP body
PER_ARCHIVE = 4000  # records in a file: 64 MB at most before compression
DATE = "2024-01-01T00:00:00Z"  # of every record, so that reruns agree

_NAMES = ("type", "record_id", "refers_to", "origin", "segment", "total", "key", "uri", "digest", "data", "payload_bytes", "payload_digest", "problem")
_RECORD = "type string, record_id string, refers_to string, origin string, segment bigint, total bigint, key string, uri string, digest string, " \
    "data binary, payload_bytes bigint, payload_digest string, problem string"  # fmt: skip
_ARROW = pa.schema([(n, pa.binary() if n == "data" else pa.int64() if n in ("segment", "total", "payload_bytes") else pa.string()) for n in _NAMES])


# Writing


def _line(value: str) -> str:
    """A value that stays on its line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{name}: {_line(value)}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))] if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The body of an HTTP message with `Transfer-Encoding: chunked`."""
    parts = (payload[i : i + size] for i in range(0, len(payload), size))
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def response_records(record_id: str, key: str | None, uri: str | None, payload: bytes, digest: str, segment: int = SEGMENT) -> Iterator[bytes]:
    """The response record of a payload and its continuations."""
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    pieces = [message[i : i + segment] for i in range(0, len(message), segment)]
    cut = len(pieces) > 1
    shared = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    yield _record(
        [("WARC-Type", "response"), ("WARC-Record-ID", f"<{record_id}>"), *shared, ("WARC-Payload-Digest", f"sha1:{digest}"),
         ("Page-Key", key), ("WARC-Segment-Number", "1" if cut else None), ("Content-Type", "application/http;msgtype=response")],
        pieces[0],
    )
    for number, piece in enumerate(pieces[1:], 2):
        yield _record(
            [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}:{number}>"), *shared, ("WARC-Segment-Origin-ID", f"<{record_id}>"),
             ("WARC-Segment-Number", str(number)), ("WARC-Segment-Total-Length", str(len(message)) if number == len(pieces) else None)],
            piece,
        )


def revisit_record(record_id: str, key: str | None, uri: str | None, digest: str, refers_to: str) -> bytes:
    return _record(
        [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
         ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", f"<{refers_to}>"), ("Page-Key", key),
         ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Type", "application/http;msgtype=response")],
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n",
    )


def _identified(pages: DataFrame, key: str, uri: str, payload: str) -> DataFrame:
    """(key, uri, digest, size, record_id, payload); the id follows from key, uri and payload, so that reruns agree."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).alias("key"), F.col(uri).cast("string").alias("uri"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("bigint")})
    parts = [F.coalesce(F.to_json(F.struct(F.col("key").cast("string").alias("k"), F.col("uri").alias("u"))), F.lit("")), F.col("digest")]
    name = F.sha1(F.concat_ws(" ", *parts))
    cuts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return rows.withColumn("record_id", F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cuts)))


def _revisits(rows: DataFrame, least: int) -> DataFrame:
    """(key, uri, record_id, digest, refers_to) of the rows that another one with the same payload stands for."""
    seen = written(rows.where(F.col("size") >= least).select("key", "uri", "record_id", "digest"), "seen")
    chief = F.max(F.struct("key", "record_id"))  # NULL is the smallest key
    chiefs = seen.groupBy("digest").agg(chief.alias("chief"), F.count("*").alias("n")).where("n > 1")
    # Written, so that both sides of the join come from a shuffle that Spark can split at a hot payload.
    chiefs = written(chiefs.select("digest", F.col("chief.key").alias("_key"), F.col("chief.record_id").alias("refers_to")), "chiefs")
    below = (F.col("key") < F.col("_key")) | (F.col("key").isNull() & F.col("_key").isNotNull())
    return written(seen.join(chiefs, "digest").where(below).select("key", "uri", "record_id", "digest", "refers_to"), "revisits")


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = LEAST, segment: int = SEGMENT,
    per_archive: int = PER_ARCHIVE,
) -> str:
    """Writes a record for each row into archives under `path`, and returns it.

    A NULL payload is empty; a NULL key is smaller than all others and is left out of the record, as is a NULL uri. Rows that
    share the largest key of a payload are all responses. Rows alike in key, uri and payload have records with the same
    id, and reading gives as many rows back. An empty table gives an empty folder. Other columns are not read. A page is in
    memory whole, its record is not longer than `segment` bytes.
    """
    rows = _identified(pages, key, uri, payload)
    revisits = _revisits(rows, least)
    # Payloads are shuffled only where a bitmap of the revisits, sized by their number, can't tell that a row is none.
    bits = 2 ** min(27, max(20, (16 * revisits.count()).bit_length()))
    ids = revisits.select("record_id")
    unsure = perhaps_in(rows, "record_id", ids, bits).join(ids, "record_id", "left_anti")
    responses = perhaps_in(rows, "record_id", ids, bits, how="left_anti").unionByName(unsure)
    columns = ["record_id", F.col("key").cast("string").alias("key"), "uri", "digest", "payload", "refers_to"]
    every = responses.withColumn("refers_to", F.lit(None).cast("string")).select(*columns)
    every = every.union(revisits.withColumn("payload", F.lit(None).cast("binary")).select(*columns))

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row in zip(*(batch.column(c) for c in ("record_id", "key", "uri", "digest", "payload", "refers_to"))):
                record_id, name, where, digest, body, refers_to = (v.as_py() for v in row)
                if refers_to is None:
                    records = response_records(record_id, name, where, body, digest, segment)
                else:
                    records = iter([revisit_record(record_id, name, where, digest, refers_to)])
                packed = pa.array((gzip.compress(r, 4, mtime=0) for r in records), pa.binary())
                yield pa.RecordBatch.from_arrays([packed], ["value"])

    # The writer ends each value with the separator, taken as bytes: an empty gzip member.
    empty = gzip.compress(b"", mtime=0).decode("iso-8859-1")
    values = every.mapInArrow(batches, "value binary").select(F.col("value").cast("string"))
    values.write.mode("overwrite").options(lineSep=empty, encoding="ISO-8859-1", maxRecordsPerFile=per_archive).text(path)
    return path


# Reading


class BrokenArchive(ValueError):
    """What stands where a record should is none."""


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """The fields (names in lower case) and the block of each record of a stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise BrokenArchive("no record")
        fields: dict[str, str] = {}
        name = ""
        while (line := stream.readline()).strip():
            text = line.decode("utf-8", "replace")
            if text[0] in " \t" and name:
                fields[name] += " " + text.strip()
            else:
                name, _, value = text.partition(":")
                name = name.strip().lower()
                fields[name] = value.strip()
        length = fields.get("content-length", "")
        if not length.isdecimal():
            raise BrokenArchive("no length")
        block = stream.read(int(length))
        if len(block) < int(length):
            raise BrokenArchive("cut short")
        yield fields, block


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over."""
    at, parts = 0, []
    while True:
        stop = body.find(b"\r\n", at)
        size = body[at:stop].split(b";")[0].strip() if stop >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]+", size):
            raise BrokenArchive("bad chunk")
        at, n = stop + 2, int(size, 16)
        if n == 0:
            return b"".join(parts)
        if body[at + n : at + n + 2] != b"\r\n":
            raise BrokenArchive("bad chunk")
        parts.append(body[at : at + n])
        at += n + 2


def payload_of(message: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, found, body = message.partition(b"\r\n\r\n")
    if not found:
        raise BrokenArchive("no HTTP header")
    coding = re.search(rb"(?im)^transfer-encoding:[ \t]*([^\r\n]*)", head)
    return unchunked(body) if coding and b"chunked" in coding[1].lower() else body


def _hex(digest: str | None) -> str | None:
    """The hex digits of a `sha1:` digest, which may be written in base 32; None for another algorithm."""
    algorithm, _, value = (digest or "").partition(":")
    if algorithm.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def finished(message: bytes, digest: str | None) -> dict[str, object]:
    """Size, digest and problem of the payload of a whole message."""
    try:
        payload = payload_of(message)
    except BrokenArchive as problem:
        return {"problem": str(problem)}
    found = hashlib.sha1(payload).hexdigest()
    wrong = digest is not None and digest != found
    return {"payload_bytes": len(payload), "payload_digest": found, "problem": "digest differs" if wrong else None}


def _parsed(content: bytes) -> Iterator[dict[str, object]]:
    plain: io.BufferedIOBase = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=plain)) if content[:2] == b"\x1f\x8b" else plain
    try:
        for fields, block in records(stream):
            kind = fields.get("warc-type", "").lower()
            if kind not in ("response", "continuation", "revisit"):
                continue
            bare = lambda name: fields[name].strip("<>") if name in fields else None
            number = lambda name: int(fields[name]) if fields.get(name, "").isdecimal() else None
            row: dict[str, object] = {
                "type": kind, "record_id": bare("warc-record-id"), "refers_to": bare("warc-refers-to"), "segment": number("warc-segment-number"),
                "total": number("warc-segment-total-length"), "key": fields.get("page-key"), "uri": bare("warc-target-uri"), "digest": _hex(fields.get("warc-payload-digest")),
            }
            if kind == "continuation" or kind == "response" and row["segment"] is not None:
                row |= {"origin": bare("warc-segment-origin-id") or row["record_id"], "data": block}
            elif kind == "response":
                row |= finished(block, row["digest"])
            yield row
    except (BrokenArchive, EOFError, OSError, zlib.error) as problem:
        yield {"type": "broken", "problem": f"{problem}"}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record; the block only of those that are a part of a longer one."""

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for content in batch.column("content"):
                part, held = [], 0
                for row in _parsed(content.as_py()):
                    part.append(row)
                    held += len(row.get("data") or b"") + 500
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_pylist(part, _ARROW)
                        part, held = [], 0
                if part:
                    yield pa.RecordBatch.from_pylist(part, _ARROW)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(batches, _RECORD)


def _assembled(pieces: DataFrame) -> DataFrame:
    """The responses whose pieces these are. Equal pieces, of rows alike, are one before anything is grouped, with their number."""
    known = F.struct("type", "key", "uri", "digest")
    single = pieces.groupBy("origin", "segment").agg(
        F.first("data").alias("data"), F.max("total").alias("total"), F.count("*").alias("copies"), F.max(F.when(F.col("segment") == 1, known)).alias("known")
    )
    origins = single.groupBy("origin").agg(
        F.array_sort(F.collect_list(F.struct("segment", "data"))).alias("parts"),
        F.max("total").alias("total"),
        F.max(F.when(F.col("segment") == 1, F.col("copies"))).alias("copies"),
        F.max("known").alias("known"),
    )
    flat = origins.select("origin", "parts", "total", F.coalesce("copies", F.lit(1)).alias("copies"), "known.key", "known.uri", "known.digest")
    schema = "record_id string, key string, uri string, copies bigint, payload_bytes bigint, payload_digest string, problem string"
    names = schema.replace(" string", "").replace(" bigint", "").split(", ")
    arrow = pa.schema([(n, pa.int64() if n in ("copies", "payload_bytes") else pa.string()) for n in names])

    def one(row: dict) -> dict:
        numbers = [p["segment"] for p in row["parts"]]
        message = b"".join(p["data"] for p in row["parts"])
        out = {"record_id": row["origin"], "key": row["key"], "uri": row["uri"], "copies": row["copies"]}
        if numbers != list(range(1, len(numbers) + 1)) or row["total"] is None:
            return out | {"problem": "segment missing"}
        if len(message) != row["total"]:
            return out | {"problem": "total length differs"}
        return out | finished(message, row["digest"])

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(batch.num_rows):  # one page in memory at a time
                yield pa.RecordBatch.from_pylist([one(batch.slice(at, 1).to_pylist()[0])], arrow)

    whole = flat.mapInArrow(batches, schema)
    return whole.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("_", "copies")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(key, uri, record_id, record_type, payload_bytes, payload_digest, refers_to, problem) of each response and revisit under `path`.

    Files are gzip or plain, of 2 GB at most, and any writer's: `key` is the field `Page-Key`, NULL where there is none. `refers_to` is
    the key of the response that a revisit names; size and digest of a revisit are those of that response. Records of
    other types are passed over. `problem` is NULL or says why a payload is not known: `segment missing`, `total length
    differs`, `bad chunk`, `no HTTP header`, `digest differs`, `response missing`. What is left of a file behind a place that is no
    record is one row of type `broken`. Records that share an id are taken for copies of each other. No files, no rows.
    """
    parsed = written(_read(spark, path), "records")

    def rows(df: DataFrame, kind: str, refers_to: Column, problem: Column) -> DataFrame:
        shown = ["key", "uri", "record_id", F.lit(kind).alias("record_type"), "payload_bytes", "payload_digest"]
        return df.select(*shown, refers_to.alias("refers_to"), problem.alias("problem"))

    none, problem = F.lit(None).cast("string"), F.col("problem")
    whole = rows(parsed.where("type = 'response' and origin is null"), "response", none, problem)
    pieces = rows(_assembled(parsed.where("origin is not null")), "response", none, problem)
    responses = written(whole.union(pieces), "responses")
    # Written, so that the join can be split at a response that very many revisits name.
    named = responses.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.first("key").alias("target"), F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")
    )
    revisits = parsed.where("type = 'revisit'").drop("payload_bytes", "payload_digest", "problem")
    found = revisits.join(written(named, "targets"), "refers_to", "left")
    missing = F.when(F.col("payload_bytes").isNull(), "response missing")
    found = rows(found, "revisit", F.col("target"), missing.when(F.col("digest") != F.col("payload_digest"), "digest differs"))
    return responses.union(found).union(rows(parsed.where("type = 'broken'"), "broken", none, problem))


def archive(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of each row, from archives written to the shared folder and read back."""
    spark = pages.sparkSession
    kind = dict(pages.dtypes)[key]
    found = read_archives(spark, write_archives(pages, new_path(spark, "archives"), key))
    return found.select(F.col("key").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
