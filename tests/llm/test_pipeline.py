"""Each stage keeps the columns of documents and does what its operator says."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import public_tokenizers

from assayer.llm import bpe, mixing
from assayer.scratch import written

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    line = lambda: " ".join(word() for _ in range(12))
    texts = ["\n".join(line() for _ in range(8)) for _ in range(40)]
    shared = line()
    texts[5] += "\n" + shared
    texts[9] = texts[9] + "\n" + shared[:-1] + "#"
    texts += [texts[0], texts[1].replace("\n", " ", 1), None, "", "too few words", "same line again and again\n" * 40, "a &&& | " * 60]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return rows, shared


def test_stages(spark):
    rows, shared = documents()
    given = spark.createDataFrame(rows, SCHEMA)
    docs, kept = given, {}
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, ""), "stage")
        kept[name] = docs.collect()
        if name != "byte-level BPE":
            assert docs.dtypes == given.dtypes
    clean = set(range(40))
    assert {r.doc_id for r in kept["quality rules"]} == clean | {40, 41}
    lines = {r.doc_id: r.text for r in kept["line dedup"]}
    assert set(lines) == clean | {41}  # an exact copy has no line left
    assert shared in lines[5] and shared[:-1] not in lines[9] and lines[9] == rows[9][1].rsplit("\n", 1)[0]
    assert all(lines[i] == rows[i][1] for i in clean - {9})
    assert {r.n_chars == len(r.text) for r in kept["line dedup"]} == {True}
    assert clean <= {r.doc_id for r in kept["near-duplicate dedup"]}
    mixed = kept["mixing"]
    assert mixed and max(sum(r.doc_id == k for r in mixed) for k in clean) <= 3
    encoder = bpe.Encoder(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    assert sorted(r.doc_id for r in kept["byte-level BPE"]) == sorted(r.doc_id for r in mixed)
    for r in kept["byte-level BPE"]:
        assert encoder.decode(list(r.ids)).decode() == lines[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(lines[r.doc_id].encode()).hexdigest()


def test_empty_table_goes_through(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, ""), "stage")
        assert docs.count() == 0


def test_null_columns_go_through(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(None, text, None, None, None), (None, text, None, None, None), (1, None, None, None, None)], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = written(stage(spark, docs, ""), "stage")
    assert {r.text for r in docs.collect()} <= {text}


def test_mixing_shuffles_no_texts(spark):
    """However many documents there are, whole rows only meet small tables."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(500)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 9))), "en", f"s{i % 3}", 7) for i in range(8000)]
    rows += [(3, "another text under a key", "en", "s1", 7), (None, "no key", "en", None, None), (None, "no key either", None, "s2", 1), (7, *rows[7][1:])]
    docs = written(spark.createDataFrame(rows, SCHEMA), "docs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")  # less than a table of all keys
    try:
        found = corpus_pipeline.mix_sources(spark, docs, "")
        got = Counter(map(tuple, found.collect()))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    most = {}
    for r in mixing.mix(docs).collect():
        most[r.doc_id] = max(most.get(r.doc_id, 0), r.copies)
    wanted = Counter()
    for r in rows:
        wanted[r] += most[r[0]]
    assert got == +wanted and found.dtypes == docs.dtypes
