"""Edit join against the edit distance of all pairs of lines."""

import random

import pytest
from pyspark.sql import functions as F

from assayer.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, edits, alphabet):
    line = list(line)
    for _ in range(edits):
        at = rng.randrange(len(line))
        kind = rng.randrange(3)
        if kind == 0:
            line[at] = rng.choice(alphabet)
        elif kind == 1:
            line.insert(at, rng.choice(alphabet))
        else:
            del line[at]
    return "".join(line)


def plain_gone(rows, edits, min_chars):
    kept = [(k, [x.strip(" \t\x0b\x0c\r") for x in (t or "").split("\n")]) for k, t in rows if k is not None]
    first = {}
    for k, parts in kept:
        for x in parts:
            if len(x) >= min_chars:
                first[x] = min(k, first.get(x, k))
    since = dict(first)
    different = list(first)
    for i, x in enumerate(different):
        for y in different[:i]:
            if abs(len(x) - len(y)) <= edits and distance(x, y) <= edits:
                since[x], since[y] = min(since[x], first[y]), min(since[y], first[x])
    out = {}
    for k, parts in kept:
        out.setdefault(k, set()).update(i for i, x in enumerate(parts) if len(x) >= min_chars and since[x] < k)
    return out


@pytest.mark.parametrize("edits", [1, 3])
def test_within_equals_the_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abé😀 ") for _ in range(rng.randint(edits + 1, 40)))
        b = edited(rng, a, rng.randint(0, edits + 2), "abé😀 ")
        pairs.append((a, b, distance(a, b) <= edits))
    df = spark.createDataFrame(pairs, "a string, b string, expected boolean").where(F.length("b") > edits)
    found = df.select("a", "b", "expected", lines.within(F.col("a"), F.col("b"), edits).alias("found")).collect()
    assert [tuple(r) for r in found if r.found != r.expected] == []


def corpus(seed):
    rng = random.Random(seed)
    line = lambda n: "".join(rng.choice("abcé ") for _ in range(n)).strip().ljust(n, "x")
    pool = [line(rng.randint(10, 26)) for _ in range(25)]
    rows = []
    for key in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            base = rng.choice(pool) if rng.random() < 0.7 else line(rng.randint(0, 30))
            parts.append(edited(rng, base, rng.choice([0, 0, 1, 2, 3]), "abcé ") if len(base) > 6 else base)
        rows.append((key, rng.choice(["\n", "\n", "  \n", "\n\n"]).join(parts)))
    rows += [(500, None), (501, ""), (None, pool[0]), (502, "\n".join([pool[1]] * 4)), (3, rows[3][1]), (503, "q" * 1_200), (504, "q" * 1_201)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("edits", "seed"), [(1, 1), (2, 2)])
def test_lines_equal_all_pairs(spark, edits, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id bigint, text string, line string, n_lines int").repartition(3)
    found = lines.dedup(docs, edits=edits, min_chars=9).collect()
    gone = plain_gone(rows, edits, 9)
    assert len(found) == len(rows)
    texts = {k: t for k, t in rows}
    for r in found:
        text, out = texts[r.doc_id], gone.get(r.doc_id, set())
        assert set(r.gone_lines) == out and r.n_gone == len(out), r.doc_id
        assert r.text == (None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out))
        assert r.n_lines == sum(bool(x.strip(" \t\x0b\x0c\r")) for x in (text or "").split("\n"))


def test_short_lines_stay(spark):
    docs = spark.createDataFrame([(1, "short"), (2, "short"), (3, "x" * 40), (4, "x" * 40)], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in lines.dedup(docs).collect()} == {1: "short", 2: "short", 3: "x" * 40, 4: ""}


def test_empty_table_and_no_python(spark):
    found = lines.dedup(spark.createDataFrame([], "doc_id bigint, text string"))
    assert found.count() == 0
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_lines_of_several_words_go(spark):
    texts = ["All rights reserved.", "All rights reserved.", "All right reservd.", "a b", "a b", "a c", "to be", "to me", "Les.", "Les.", " x\ty ", "x\ty", "é 😀", "é 😀"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id for r in lines.dedup(docs).collect() if r.n_gone}
    assert found == {1, 2, 4, 7, 11, 13}


def test_default_lines_equal_all_pairs(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = [(k, [x.strip(" \t\x0b\x0c\r") for x in (t or "").split("\n")]) for k, t in rows if k is not None]
    counts = lambda x: len(x) >= 30 or " " in x
    first = {}
    for k, parts in kept:
        for x in filter(counts, parts):
            first[x] = min(k, first.get(x, k))
    near = lambda x, y: min(len(x), len(y)) > 4 and abs(len(x) - len(y)) <= 2 and distance(x, y) <= 2
    since = {x: min(k for y, k in first.items() if x == y or near(x, y)) for x in first}
    gone = {}
    for k, parts in kept:
        gone.setdefault(k, set()).update(i for i, x in enumerate(parts) if counts(x) and since[x] < k)
    for r in lines.dedup(docs).where("doc_id IS NOT NULL").collect():
        assert set(r.gone_lines) == gone[r.doc_id], r.doc_id


def test_hashes_are_rows_and_what_makes_them_is_compiled(spark):
    """A segment that has not moved is one row, and no generated method is too long for the JVM's compiler (8,000 bytes)."""
    docs = spark.createDataFrame([(1, "a line of some forty characters, no more"), (2, "short")], "doc_id bigint, text string")
    found = lines._hashes(lines._lines(docs, "doc_id", "text", 5), 2)
    assert [(r["count"], r.own) for r in found.groupBy("a").agg(F.count("*").alias("count"), F.expr("count_if(segment)").alias("own")).collect()] == [(12, 3)] * 2
    code = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "codegen")
    sizes = [int(part.split(";")[0].split(")")[0]) for part in code.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000


def test_texts_are_read_in_the_first_documents_only(spark, rows, monkeypatch):
    kept = {}
    written = lines.written
    monkeypatch.setattr(lines, "written", lambda df, name: kept.setdefault(name, written(df, name)))
    line = "the quick brown fox jumps over the lazy dog"
    docs = spark.createDataFrame([(3, line), (5, line.replace("quick", "quack")), (7, line), (9, line + "!"), (None, line)], "doc_id bigint, text string")
    found = lines.dedup(docs).select("doc_id", "n_gone")
    assert rows(found) == sorted([(3, 0), (5, 1), (7, 1), (9, 1), (None, 0)], key=lambda t: (t[0] is None, str(t[0])))
    assert sorted(r["first"] for r in kept["first-places"].collect()) == [3, 5, 9]


def test_lines_are_walked_through_only_where_they_must_be(spark):
    """Only lines with space around them are trimmed, and pieces of ASCII lines are cut as bytes."""
    texts = ["café au lait, a line of some length", "\tcafe au lait, a line of some length\r", "\x01cafe au lait\x7f, a line", "日本語 の 長い 行", " \x0b\x0c "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = lines._lines(docs, "doc_id", "text", 1)
    assert {r.key: r.line for r in found.collect()} == {i: t.strip(" \t\x0b\x0c\r") for i, t in enumerate(texts[:4])}
    hashes = lines._hashes(found, 2)
    plan = hashes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("trim(") == plan.count("THEN trim(") > 0
    assert "substring(raw" in plan
    of = {a: {r.hash for r in hashes.where(F.col("a") == a).collect()} for a in (r.a for r in found.where("key < 2").collect())}
    one, two = of.values()
    assert one & two  # the last segments of a line in ASCII and of one that is not
