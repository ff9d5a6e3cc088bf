"""Pairs against a plain rendering of both conversations."""

from assayer.llm import preferences as p


def render(turns):
    return "".join(f"{p.START}{r}{p.BODY}{t}{p.END}" for r, t in turns)


def plain(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1

    def mask(turns):
        out, at = [], 0
        for r, t in turns:
            head = at + len(p.START) + len(r) + len(p.BODY)
            at = head + len(t) + len(p.END)
            if r == "assistant":
                out.append((head, at))
        return out

    c, r = chosen[n:], rejected[n:]
    return n, render(chosen[:n]), render(c), mask(c), render(r), mask(r)


CONVERSATIONS = {
    0: [("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "good bye é😀")],
    1: [("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "go away")],
    2: [("user", "same"), ("assistant", "same")],
    3: [("user", "same"), ("assistant", "same")],
    4: [("system", "s"), ("user", "long " * 5000)],
    5: [("user", "other")],
    6: [("user", "no partner"), ("assistant", "")],
    9: [("assistant", "only rejected")],
    10: [("user", "prefix")],
    11: [("user", "prefix"), ("assistant", "more"), ("user", "x"), ("assistant", "y")],
    -2: [("user", "negative")],
}


def frame(spark):
    rows = [(k, i, r, t, "x") for k, turns in CONVERSATIONS.items() for i, (r, t) in enumerate(turns)]
    rows += [rows[0], (12, None, None, None, "x"), (12, 0, "user", None, "x"), (None, 0, "user", "no key", "x")]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, prompt string").repartition(3)


def values(r):
    return (r.prompt_turns, r.prompt, r.chosen, [tuple(x) for x in r.chosen_mask], r.rejected, [tuple(x) for x in r.rejected_mask])


def test_neighbours_equal_plain_rendering(spark):
    found = p.neighbours(p.turns(frame(spark)))
    assert "Python" not in found._jdf.queryExecution().toString()
    got = {r.pair_id: r for r in found.collect()}
    everything = {**CONVERSATIONS, 12: [("user", ""), ("", "")]}
    assert set(got) == {k // 2 for k in everything}
    for pair, r in got.items():
        assert values(r) == plain(everything.get(2 * pair, []), everything.get(2 * pair + 1, []))


def test_masked_text_is_what_the_assistant_says(spark):
    row = next(r for r in p.neighbours(p.turns(frame(spark))).collect() if r.pair_id == 0)
    (start, end), = row.chosen_mask
    assert row.chosen[start:end] == "good bye é😀" + p.END and row.prompt_turns == 3


def test_given_pairs(spark):
    pairs = spark.createDataFrame([(1, 1, 0), (2, 10, 11), (3, 77, 5), (4, None, 2), (4, None, 2)], "pair_id int, chosen_id bigint, rejected_id bigint")
    got = p.preferences(pairs, p.turns(frame(spark))).collect()
    assert len(got) == 5
    by = {r.pair_id: r for r in got}
    c = CONVERSATIONS
    assert values(by[1]) == plain(c[1], c[0]) and values(by[2]) == plain(c[10], c[11])
    assert values(by[3]) == plain([], c[5]) and values(by[4]) == plain([], c[2])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert p.neighbours(p.turns(empty)).count() == 0
