"""Components against all pairs of full sets."""

import random
import re

import numpy as np
import pytest

from assayer.llm import neardup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, words):
    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return frozenset()
    width = min(words, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def plain_components(rows, words, percent):
    sets = [plain_set(t, words) for _, t in rows]
    parent = {k: k for k, _ in rows if k is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(k, len(s), None if k is None else root(k)) for (k, _), s in zip(rows, sets)]


def corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    sentence = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, key = [], 0
    for _ in range(25):  # chains and clouds of near copies, at all similarities
        base = sentence(rng.randint(5, 120))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            text = rng.choice([" ", "\n", "  "]).join(copy)
            rows.append((key := key + 1, text.upper() if rng.random() < 0.2 else text))
            if rng.random() < 0.4:
                base = copy
    passage = sentence(60)
    rows += [(key + i, " ".join(passage + sentence(20))) for i in range(1, 25)]  # a shared passage, similarity about 0.6
    key += 25
    rows += [(key + i, "exact copy of a short text") for i in range(40)]
    key += 40
    rows += [(key, None), (key + 1, ""), (key + 2, " \n "), (key + 3, "one"), (key + 4, "ONE"), (key + 5, "one two"), (key + 6, "a b c d")]
    rows += [(key + 7, "w " * 30_000), (key + 8, "w " * 9), (None, "exact copy of a short text"), rows[3], rows[3]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words", [4, 5])
def test_components_equal_all_pairs(spark, words):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, 0, "x") for k, t in rows], "doc_id bigint, text string, n int, band string").repartition(4)
    found = neardup.near_duplicates(docs, words=words).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == sorted(plain_components(rows, words, 80), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)


def test_rows_of_one_key_join_their_links(spark):
    one, two = "a b c d e f g", "q r s t u v w"
    docs = spark.createDataFrame([(1, one), (7, one), (7, two), (9, two), (3, two)], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs).collect()} == {(1, 1), (7, 1), (9, 1), (3, 1)}


def test_sketches_tell_similarities(spark):
    rng = np.random.default_rng(1)
    pairs = []
    for share in (1.0, 0.95, 0.9, 0.8):
        common = rng.integers(0, 2**63, 3000, dtype=np.uint64)
        only = round(3000 * (1 / share - 1) / 2)
        sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, only, dtype=np.uint64)])) for _ in range(2)]
        pairs.append((share, *[neardup.odd_sketch(neardup.min_hashes(s)).tolist() for s in sets]))
    df = spark.createDataFrame(pairs, "share double, a array<bigint>, b array<bigint>")
    for row in df.select("share", neardup.similar(df.a, df.b).alias("told")).collect():
        assert abs(row.told - row.share) < 0.1


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
