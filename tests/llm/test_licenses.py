import random
import re

import duckdb
import pytest

from stallbook.llm import licenses, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
KINDS = list(licenses.KINDS)
COMPILED = [(rule, re.compile(rf"(?:{rule.pattern})(?= |$)")) for rule in licenses.rules()]


def plain(text):
    """(n_words, base, matches) by trying every rule at every word of the whole text."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    base = sorted((i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split())
    found = []
    for i in range(len(words)):
        ahead = " ".join(words[i:i + licenses.WIDEST])
        hits = [(KINDS.index(rule.kind), -len(m[0].split(" ")), k, rule.label)
                for k, (rule, pattern) in enumerate(COMPILED) if (m := pattern.match(ahead))]
        if hits:
            kind, shorter, _, label = min(hits)
            found.append((i, i - shorter, kind, label))
    kept = [m for m in found if not any(o[0] < m[0] and o[1] >= m[1] and o[2] <= m[2] for o in found)]
    return len(words), base, kept


def as_tuples(row):
    return row.n_words, sorted(map(tuple, row.base)), list(map(tuple, row.matches))


def same(spark, texts):
    found = licenses.licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(found) == len(texts)
    for row in found:
        assert as_tuples(row) == plain(texts[row.id]), texts[row.id]


def test_every_rule(spark):
    """Each rule finds its own words, whatever the gate and the keywords leave out, as without them."""
    texts = []
    for rule, pattern in COMPILED:
        simple = re.sub(r"licen\[sc\]e", "license", rule.pattern)
        simple = re.sub(r"\(\?:\[\^ \]\+ \)\{1,12\}", "one or two ", simple).replace(" ?", "")
        while re.search(r"\(\?:[^()]*\)\??", simple):       # optional parts go, of alternatives the first stays
            simple = re.sub(r"\(\?:([^()]*)\)(\??)", lambda m: "" if m[2] else m[1].split("|")[0], simple)
        simple = simple.replace("names?", "name").replace("an?", "a").replace("versions?", "version")
        assert pattern.match(simple), (rule, simple)
        assert simple.split(" ")[0] in rule.first and rule.keyword in simple
        assert set(simple.split(" ")) & set(licenses.GATE), simple
        texts.append(f"It says: {simple.title()}!")
    same(spark, texts)


def test_same_as_every_rule_at_every_word(spark):
    chance = random.Random(3)
    parts = ["GNU", "General", "Public", "License", "licence", "version", "v3", "2.0", "2", "3", "0", "or later", "Apache", "MIT",
             "cc", "by", "sa", "4.0", "nc", "licensed under", "released under the terms of the", "SPDX-License-Identifier:", "GPL-2.0",
             "the", "opensource.org/licenses/", "mit", "bsd", "2-Clause", "all rights reserved", "x", "é", ".", "lİcense", "K", "\n",
             "creative commons attribution", "ShareAlike", "gplv3", "lesser", "mozilla public license", "this work is in the public domain"]
    texts = [" ".join(chance.choice(parts) for _ in range(chance.randrange(25))) for _ in range(1500)]
    same(spark, texts)


def test_suppression():
    one = plain("Licensed under the Apache License, Version 2.0")[2]
    assert one == [(0, 8, KINDS.index("statement"), "apache-2.0")]
    assert [m[3] for m in plain("GNU Lesser General Public License v2.1 or later; MIT license")[2]] == ["lgpl-2.1", "mit"]


def test_odd_rows(spark, odd_documents, no_documents):
    found = licenses.licenses(odd_documents).collect()
    expected = sorted((repr(r.doc_id), plain(r.text)) for r in odd_documents.collect())
    assert sorted((repr(r.id), as_tuples(r)) for r in found) == expected
    assert licenses.licenses(no_documents).collect() == []
    again = licenses.summary(licenses.licenses(odd_documents.withColumn("result", odd_documents.text))).collect()
    assert len(again) == len(expected) and {r.labels for r in again} == {""} and {r.score for r in again} == {0.0}


@pytest.mark.parametrize("text, n_base", [("MIT License. " * 20_000, 20_000), ("released under " * 30_000 + "mit license", 1),
                                          ("y" * 500_000 + " CC BY", 1)])
def test_long_texts(spark, text, n_base):
    (row,) = licenses.licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(row.base) == n_base and len(row.matches) >= n_base and row.n_words == len(WORD.findall(text.lower()))


def test_plan_is_native(spark, odd_documents):
    plan = licenses.summary(licenses.licenses(odd_documents))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    optimized = licenses.licenses(odd_documents)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in optimized and optimized.count("regexp_replace") == 1


def test_query_and_its_sql(spark):
    found = queries.queries()["op13_licenses"](spark, "/root/testdata/sf0.001")
    ours = sorted(map(tuple, found.collect()), key=repr)
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    con.execute(queries.oracle_sql()["op13_licenses"])
    names = [d[0] for d in con.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted((tuple(r[names.index(c)] for c in found.columns) for r in con.fetchall()), key=repr) == ours
    assert any(row[5] for row in ours)
