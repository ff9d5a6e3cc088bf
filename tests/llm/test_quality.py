"""Features and verdicts against plain counting; the order of rules changes no verdict."""

import re

import pytest

from assayer.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


TEXTS = [
    None, "", "   \n\t", "one", "a b c a b c", "a a a a a", "x y\nx y\n\nx y \n", "ünï\xa0cödé\x85x 中文 \x1c y", "# * | <a> & 100%",
    " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 10}" for i in range(60)), "\n".join(["same line here"] * 30),
    " ".join(f"w{i}&&&" for i in range(80)), " | ".join(f"w{i}" for i in range(80)), " ".join(str(i) for i in range(100)),
    "z" * 20_000, "word " * 5_000, "é" * 3000 + " " + " ".join(f"w{i}" for i in range(90)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, "null key", "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept string")


def test_features_equal_plain_counts(docs):
    found = quality.judge(docs, quality.RULES, report=quality.REPORTED).collect()
    assert len(found) == len(TEXTS) + 2
    for row in found:
        text = "null key" if row.doc_id is None else TEXTS[row.doc_id]
        assert tuple(row)[1:7] == plain(text), text
        assert not (row.base_failed and row.kept)


def test_verdict_is_the_same_in_any_order(docs):
    orders = [quality.RULES, quality.RULES[::-1], quality.cascade(docs)]
    verdicts = [sorted((str(r.doc_id), r.kept) for r in quality.judge(docs, o).collect()) for o in orders]
    assert verdicts[0] == verdicts[1] == verdicts[2]
    plain_verdict = {i: not any(r.rejects(quality.Features(t)) for r in quality.RULES) for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.kept for r in quality.judge(docs, quality.RULES).collect() if r.doc_id is not None} == plain_verdict
    assert plain_verdict[9] and not any(plain_verdict[i] for i in (10, 11, 12, 13, 14))


def test_cheap_and_selective_rules_come_first(spark):
    docs = spark.createDataFrame([(i, "few words") for i in range(300)], "doc_id int, text string")

    def slow(features):
        return sum(range(20_000)) < 0

    rules = [quality.Rule("slow", slow), quality.Rule("never", lambda f: False), quality.FEW_WORDS]
    assert quality.cascade(docs, rules)[0].name == "few_words"


def test_a_rejected_text_is_not_looked_at_again(spark):
    def fails(features):
        raise ValueError("not to be asked")

    docs = spark.createDataFrame([(1, "few")], "doc_id int, text string")
    assert not quality.judge(docs, [quality.FEW_WORDS, quality.Rule("never", fails)]).first().kept


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality.judge(docs, quality.cascade(docs), report=quality.REPORTED).count() == 0
