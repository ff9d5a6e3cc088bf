"""Base spans against plain expressions over whole texts; learned spans from planted contexts."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from assayer.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += (d * 2 - 9 if d > 4 else d * 2) if i % 2 else d
    return total % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out)]


TEXTS = [
    None, "", " ", "no data here", "a@b.c+d@e.f", "x@y@z.w a@b a.b@c-d.e.", "1.2.3.4.5.6.7.8 1.2.3.256.9.9.9 999.1.1.1 0001.02.3.04",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 5 4111111111111111", "+1 (988) 555-2485, +44 20 7946 0958. +1", "+1234567890123456 +12 345",
    "é中 me@x.org 😀 10.0.0.1 😀 +49 (30) 1234567 x4012888888881881y", "a" * 30_000, "1" * 30_000, "1 " * 8_000, "+" * 2000, "@" * 2000,
    "1.1.1.1." * 700, "a@b.co " * 1500, "9" * 12 + " " + "0" * 12, "- -1-1 2--3 4- 5", "mail:joe.bloggs@mail.example.com\nip\t192.168.0.1",
    "user@host.c0m 4111 1111 1111 1111 +4111111111111111", "12.34.56.78@host.example", "٠123456789012 ４１１１111111111111",
]


def test_base_spans_equal_plain_expressions(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "clash"), (None, TEXTS[9], None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string").repartition(4)
    found = pii.digest(pii.find(docs)).collect()
    assert len(found) == len(rows)
    for row in found:
        expected = plain_spans(TEXTS[9] if row.doc_id is None else TEXTS[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), (row.doc_id, expected[:3])
        assert row.spans == ",".join(expected)
        counts = [sum(e.startswith(k) for e in expected) for k in PLAIN]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts


def test_base_spans_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for row in pii.digest(pii.find(docs)).collect():
        assert row.base_sha256 == hashlib.sha256(",".join(plain_spans(texts[row.doc_id])).encode()).hexdigest()


@pytest.fixture(scope="module")
def taught(spark):
    """Phones after `please call`, of which two are written as no expression expects."""
    rows = [(i, f"word{i} please call +1 555 010 {1000 + i} today thanks", "s") for i in range(30)]
    rows += [(100, "so please call 555.0199.77 today ok", "s"), (101, "or please call (555)0188-22 today ok", "s")]
    rows += [(i, f"part number {77000 + i} in stock", "s") for i in range(200, 230)]
    rows += [(i, f"copy copy write to a@b.example now order {880000 + i} soon", "s") for i in range(300, 340)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_contexts_of_seeds_find_unseen_values(taught):
    found = {r.doc_id: r for r in pii.find(taught).collect()}
    new = {k: [(s.kind, taught_text(taught, k)[s.start : s.end]) for s in r.spans if s not in r.base] for k, r in found.items()}
    assert new[100] == [("phone", "555.0199.77")]
    assert new[101] == [("phone", "(555)0188-22")]
    assert not any(v for k, v in new.items() if k not in (100, 101))


def taught_text(df, key):
    return df.where(F.col("doc_id") == key).first().text


def test_one_value_however_often_is_no_evidence(spark):
    rows = [(i, "reach me at a@b.example please", "s") for i in range(60)] + [(99, "reach me at a55512345 please", "s")]
    found = pii.find(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert all(r.spans == r.base for r in found)


def test_empty_table(spark):
    assert pii.digest(pii.find(spark.createDataFrame([], "doc_id bigint, text string"))).count() == 0


def test_no_python_in_the_plan(spark, taught):
    plan = pii.digest(pii.find(taught))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_identifiers_of_several_tokens_few_digits_or_without_a_word_before(spark):
    rows = [(i, f"word{i} please call +1 555 010 {1000 + i} today thanks") for i in range(40)]
    rows += [(i + 50, f"+1 555 020 {1000 + i} is mine") for i in range(20)]
    more = {
        100: ("so please call 555 123 4567 today ok", "555 123 4567"), 101: ("now please call (555) 123-4567 today", "(555) 123-4567"),
        102: ("or please call 4111 1111 1111 1112 today", "4111 1111 1111 1112"), 103: ("do please call AB1234 today", "AB1234"),
        104: ("555-0199-77 is mine", "555-0199-77"), 105: ("AB1234 is a part, 555 rows of 1234 99 items", None),
    }
    rows += [(k, text) for k, (text, _) in more.items()]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for k, (text, value) in more.items():
        assert [text[s.start : s.end] for s in found[k].spans] == ([value] if value else []), k
    assert all(r.spans == r.base for k, r in found.items() if k not in more)
