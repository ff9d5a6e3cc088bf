"""Round trips through archives, and archives that are not as they should be."""

import base64
import gzip
import hashlib
import io
import os

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import differences

from assayer.llm import oracles, warc


def sha1(data):
    return hashlib.sha1(data).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50), st.integers(1, 400))
def test_records_round_trip(payload, chunk, segment):
    found = list(warc.records(io.BytesIO(b"".join(warc.response_records("a", "1", "u", payload, sha1(payload), segment)))))
    message_size = sum(len(block) for _, block in found)
    assert all(len(block) <= segment for _, block in found)
    assert warc.payload_of(b"".join(block for _, block in found)) == payload
    assert len(found) == -(-message_size // segment)
    if len(found) > 1:
        assert found[-1][0]["warc-segment-total-length"] == str(message_size)
    assert warc.unchunked(warc.chunked(payload, chunk)) == payload


def test_chunk_extensions_trailers_and_faults():
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"3\r\nabcd\r\n0\r\n\r\n", b"x\r\n", b"-1\r\n\r\n", b"3\r\nabc\r\n"):
        with pytest.raises(warc.BrokenArchive):
            warc.unchunked(broken)


SCHEMA = "html string, url string, page_id bigint, key string, uri string, digest string, n int"
LONG = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n0\r\n" + "é\n\r\n<p>" * 300_000
PAGES = [
    (1, "a", "x" * 1000), (2, "b", "x" * 1000), (9, None, "x" * 1000), (3, "c", "x" * 999), (4, "d", "x" * 999),
    (5, "e", None), (6, "f", ""), (7, "g\r\nWARC-Type: revisit", "é" * 500), (8, "h", "é" * 500), (10, "ü", LONG), (11, "k", LONG), (12, "l", LONG + "!"),
    (13, "m", "y" * 40_000), (13, "m", "y" * 40_000), (13, "m", "y" * 40_000), (14, "n", "z" * 1200), (14, "n", "z" * 1200), (14, "o", "z" * 1200),
    (15, "p", "z" * 1200 + "\r\n"), (None, "q", "w" * 2000), (None, "q", "v" * 3000), (16, "r", "v" * 3000), (-5, "s", "v" * 3000),
    *[(100 + i, "hot", "<html>" * 4000) for i in range(60)],
]


def pages(spark, data):
    return spark.createDataFrame([(html, url, key, "k", "u", "d", 1) for key, url, html in data], SCHEMA)


def test_equals_sql(spark, tmp_path):
    pages(spark, PAGES).coalesce(1).write.parquet(str(tmp_path / "p"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/p/*.parquet'")
    assert differences(warc.archive(spark.read.parquet(str(tmp_path / "p")).repartition(5)), oracles.WEB_ARCHIVE, connection) == []
    connection.close()


def test_no_pages(spark):
    found = warc.archive(pages(spark, []))
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] and found.collect() == []


def test_archives_are_warc_files(spark, tmp_path):
    path = warc.write_archives(pages(spark, PAGES).repartition(3), str(tmp_path / "a"), segment=1000, per_archive=50)
    files = [f"{path}/{f}" for f in os.listdir(path) if f.startswith("part")]
    assert len(files) > len(PAGES) // 50
    found = [r for f in files for r in warc.records(gzip.open(f))]
    kinds = [fields["warc-type"] for fields, _ in found]
    assert kinds.count("response") + kinds.count("revisit") == len(PAGES) and kinds.count("continuation") > 3000
    assert all(len(block) <= 1000 for _, block in found) and all(f["warc-date"] == warc.DATE for f, _ in found)
    read = warc.read_archives(spark, path)
    assert read.where("problem is not null").count() == 0 and read.count() == len(PAGES)


def gathered(spark, folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as file:
        file.write(data)
    columns = "key", "record_type", "payload_bytes", "refers_to", "problem"
    return sorted([tuple(r) for r in warc.read_archives(spark, str(folder)).select(*columns).collect()], key=str)


def test_what_is_wrong_is_told(spark, tmp_path):
    body = b"b" * 2500
    long = list(warc.response_records("long", "1", "u", body, sha1(body), 1000))
    assert len(long) == 3
    fine = ("1", "response", 2500, None, None)
    told = lambda problem, key="1": (key, "response", None, None, problem)
    shuffled = b"".join([long[2], long[0], long[1]])
    assert gathered(spark, tmp_path / "a", "x", shuffled) == [fine]
    assert gathered(spark, tmp_path / "b", "x", long[0] + long[2]) == [told("segment missing")]
    assert gathered(spark, tmp_path / "c", "x", long[0] + long[1]) == [told("segment missing")]
    assert gathered(spark, tmp_path / "d", "x", long[1] + long[2]) == [told("segment missing", None)]
    other = long[2].replace(b"Total-Length: ", b"Total-Length: 1")
    assert gathered(spark, tmp_path / "e", "x", long[0] + long[1] + other) == [told("total length differs")]
    wrong = b"".join(warc.response_records("w", "2", "u", body, sha1(b"other")))
    assert gathered(spark, tmp_path / "f", "x", wrong) == [("2", "response", 2500, None, "digest differs")]
    lost = warc.revisit_record("v", "3", "u", sha1(body), "nowhere")
    assert gathered(spark, tmp_path / "g", "x", lost) == [("3", "revisit", None, None, "response missing")]
    small = b"".join(warc.response_records("s", "4", "u", b"abc", sha1(b"abc")))
    for at, rest in enumerate((b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"garbage", small[:-9])):
        assert gathered(spark, tmp_path / f"h{at}", "x", small + rest) == sorted(
            [("4", "response", 3, None, None), (None, "broken", None, None, ["no length", "no record", "cut short"][at])], key=str
        )
    assert gathered(spark, tmp_path / "i", "x", gzip.compress(small)[:-20])[-1][1] in ("broken", "response")


def test_archives_of_other_writers(spark, tmp_path):
    """A plain file, a digest in base 32, no chunks, folded fields, other records, parts of one page in two files."""
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\nhello"
    digest = base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    record = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:a>\r\nX-Note: one\r\n  two\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(message)}\r\n\r\n"
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nx: y\r\n\r\n"
    parts = list(warc.response_records("p", "5", "u", b"c" * 1500, sha1(b"c" * 1500), 1000))
    gathered(spark, tmp_path, "one.warc.gz", gzip.compress(parts[1]))
    assert gathered(spark, tmp_path, "two.warc", info + record.encode() + message + b"\r\n\r\n" + parts[0]) == [
        ("5", "response", 1500, None, None), (None, "response", 5, None, None)
    ]
