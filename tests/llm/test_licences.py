"""Sentences and rules against a plain scan of the parts of each text."""

import re

from pyspark.sql import functions as F

from assayer.llm import licences

S = licences.SENTENCES


def plain_scan(text):
    known = licences.known_sentences(S)
    parts = [p for p in map(licences.plain, re.split(licences._ENDS, text or "")) if p]
    ids, at = [], 0
    while at < len(parts):
        for n in range(100, 0, -1):
            if at + n <= len(parts) and " ".join(parts[at : at + n]) in known:
                ids.append(known[" ".join(parts[at : at + n])])
                at += n
                break
        else:
            at += 1
    found, left = set(), [(i, name) for i, name in enumerate(ids)]
    for rule in licences.RULES:
        k, n = 0, len(rule.sentences)
        while k + n <= len(left):
            window = left[k : k + n]
            if tuple(x[1] for x in window) == rule.sentences and all(b[0] - a[0] == 1 for a, b in zip(window, window[1:])):
                found.add(rule.licence)
                del left[k : k + n]
            else:
                k += 1
    return ids, sorted(found), [name for _, name in left]


MIT = f"Copyright 2020\n{S['mit-grant']}\n\n{S['mit-condition']}\nrest"
TEXTS = [
    None, "", " ", "nothing here. Licensed under nothing.", S["mit-notice"], "x\n" + S["apache-notice"].upper() + "\ny", MIT,
    S["mit-grant"].replace(" ", "\n", 3), S["mit-condition"], f"{S['apache-notice-the']}\n{S['apache-comply']}\n{S['apache-copy']}\nhttp://x\n{S['apache-as-is']}",
    f"{S['apache-notice-the']} {S['apache-comply']} {S['apache-copy']} {S['apache-as-is']}", f"{S['gpl-free']}  {S['gpl-warranty']}  {S['gpl-details']}",
    f"{S['gpl-warranty']} in between. {S['gpl-free']}", f"{S['bsd-grant']} {S['bsd-source']} {S['bsd-binary']}", f"{S['bsd-grant']} x. {S['bsd-source']}",
    f"{S['cc-by-nc-notice']} {S['rights']} {S['mit-notice']} {S['mit-notice']}", "é. " * 3000 + S["gpl3-notice"], "a" * 50_000, "SPDX-License-Identifier: MIT",
    f"{S['mit-grant']} {S['mit-grant']} {S['mit-condition']}",
]


def test_scan_equals_plain_scan(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "clash"), (None, MIT, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, sentences string")
    found = licences.scan(docs)
    assert "Python" not in found._jdf.queryExecution().toString()
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        text = MIT if r.doc_id is None else TEXTS[r.doc_id]
        assert (r.sentences, r.licences, r.unmatched) == plain_scan(text), text
    assert {r.doc_id: r.licences for r in got}[6] == ["MIT"]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = licences.scan(docs).where(F.size("sentences") > 0).collect()
    assert len(got) > 5
    assert {r.doc_id: r.licences for r in got} == {k: plain_scan(t)[1] for k, t in texts.items() if plain_scan(t)[0]}


def wording(*names):
    return "\n\n".join(S[name] for name in names)


FULL = {
    "BSD-3-Clause": f"Copyright (c) 2020\n{S['bsd-grant']}\n1. {S['bsd-source']}\n2. {S['bsd-binary']}\n3. {S['bsd-endorse']}\n{wording('bsd-warranty', 'bsd-liability')}",
    "BSD-2-Clause": wording("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability"),
    "MIT": wording("mit-grant", "mit-condition", "mit-warranty", "mit-liability"),
    "MIT-0": wording("mit0-grant", "mit-warranty", "mit-liability"),
    "ISC": wording("isc-grant", "isc-warranty", "isc-liability"),
    "0BSD": wording("0bsd-grant", "isc-warranty", "isc-liability"),
    "GPL-2.0-or-later": wording("gpl2-later", "gpl-warranty", "gpl-details", "gpl-received"),
    "GPL-2.0-only": wording("gpl2-only", "gpl-warranty", "gpl-details"),
    "LGPL-2.1-or-later": wording("lgpl21-later", "lgpl-warranty", "lgpl-details"),
    "LGPL-3.0-or-later": wording("lgpl3-later", "gpl-warranty", "lgpl-details"),
    "AGPL-3.0-or-later": wording("agpl3-later", "gpl-warranty", "agpl-details"),
    "MPL-2.0": wording("mpl-notice", "mpl-copy"),
    "Unlicense": wording("unlicense-public", "unlicense-grant"),
    "Zlib": wording("zlib-warranty", "zlib-grant"),
    "Apache-2.0": wording("apache-notice-the", "apache-comply", "apache-copy", "apache-as-is", "apache-conditions", "apache-language"),
}


def test_every_licence_of_the_table(spark):
    texts = list(FULL.items()) + [(licence, text) for licence, text in licences._built().values()]
    wrapped = [(k, t.replace(", ", ",\n").lower()) for k, t in FULL.items()]
    rows = [(i, licence, text) for i, (licence, text) in enumerate(texts + wrapped)]
    found = licences.scan(spark.createDataFrame(rows, "doc_id bigint, licence string, text string"), ["doc_id", "licence", "text"]).collect()
    assert len(found) == len(rows) > 120
    for r in found:
        assert (r.licences, r.unmatched) == ([r.licence], []), r.text
        assert (r.sentences, r.licences, r.unmatched) == plain_scan(r.text)


def test_no_rules_and_rules_of_one_sentence_before_longer_ones(spark):
    docs = spark.createDataFrame([(1, "a. b. a.")], "doc_id bigint, text string")
    known, rule = {"a": "a", "b": "b"}, licences.LicenceRule
    assert licences.scan(docs, sentences=known, rules=()).first()[1:] == (["a", "b", "a"], [], ["a", "b", "a"])
    first = licences.scan(docs, sentences=known, rules=(rule("A", ("a",)), rule("AB", ("a", "b")))).first()
    assert first[1:] == (["a", "b", "a"], ["A"], ["b"])
    both = licences.scan(docs, sentences=known, rules=(rule("AB", ("a", "b")), rule("A", ("a",)), rule("never", ("a",)))).first()
    assert both[1:] == (["a", "b", "a"], ["A", "AB"], [])


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
