import hashlib
import random
import re

import pytest

from stallbook.llm import pii, queries

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_base(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) \
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) \
                    or kind == "phone" and 8 <= len(digits) <= 15:
                found.append((kind, m.start(), m.end()))
    return found


PARTS = ["a@b.co", "x.y+z@", "@", ".", "..", "-", "192.168.0.1", "1.2.3.4.5", "256.1.1.1", "007.008.009.010", "4111111111111111",
         "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559 4", "+1 (736) 555-2678", "+", "+4", "12", " ", "é", "𝄞",
         "\n", "call", "0000000000000000000", "(555) 123-4567", "123-45-6789", "ssn", "version ", "a@b.c_d@e.f", "%"]


def base(row):
    return [tuple(s) for s in row.spans if s.kind in PLAIN]


def test_same_as_plain_patterns(spark):
    chance = random.Random(1)
    texts = ["".join(chance.choice(PARTS) + chance.choice(["", "", " "]) for _ in range(chance.randrange(30))) for _ in range(600)]
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert base(row) == plain_base(texts[row.id]), texts[row.id]
        places = [(pii.KINDS.index(s.kind), s.start) for s in row.spans]
        assert places == sorted(places)


@pytest.mark.parametrize("run", [lambda n: "1" * n, lambda n: "1 " * n, lambda n: "a" * n + "@", lambda n: "a@b" + ".c" * n,
                                 lambda n: "+1" + "(" * n, lambda n: "a@b.c " * (n // 40) + "x" * n])
def test_long_runs(spark, run):
    """As the plain patterns on a short run; a long one, on which those would take hours, ends in time."""
    table = spark.createDataFrame([(1, run(2000)), (2, run(100_000))], "doc_id long, text string")
    short, long = sorted(pii.personal_data(table).collect())
    assert base(short) == plain_base(run(2000))
    assert bool(base(long)) == bool(base(short))


def test_odd_rows(spark, odd_documents, no_documents):
    assert [row.spans for row in pii.personal_data(odd_documents).collect()] == [[]] * odd_documents.count()
    assert pii.personal_data(no_documents).collect() == []
    twice = spark.createDataFrame([(None, "call 555-123-4567 or a@b.com")] * 2, "doc_id long, text string")
    one, two = pii.personal_data(twice).collect()
    assert one == two and ("email", 21, 28) in [tuple(s) for s in one.spans]


def test_method_adds_what_the_labelers_agree_on(spark):
    rows = [(k, f"please call {200 + k}-555-{1000 + k} soon") for k in range(200)]
    rows += [(1000 + k, f"released as version {10 + k % 80}.{10 + k % 70}.{10 + k % 60} of the tool") for k in range(200)]
    found = {r.id: [s.kind for s in r.spans] for r in pii.personal_data(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(bool(found[k]) for k in range(200)) > 190
    assert sum(bool(found[1000 + k]) for k in range(200)) < 10


def test_em_finds_the_bad_labeler():
    chance = random.Random(2)
    counts = {}
    for _ in range(4000):
        truth = chance.random() < 0.6
        pattern = tuple((1 if truth == (chance.random() < right) else -1) if chance.random() < 0.9 else 0
                        for right in (0.95, 0.9, 0.85, 0.55))
        counts[pattern] = counts.get(pattern, 0) + 1
    share, tables = pii.reliabilities(list(counts.items()))
    right = [t[1, 1] / (t[1, 1] + t[-1, 1]) for t in tables]
    assert abs(share - 0.6) < 0.1 and min(right[:3]) > 0.8 and right[3] < 0.7


def test_plan_is_native(spark, odd_documents):
    plan = pii.candidates(odd_documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark, table):
    found = {r.doc_id: r for r in queries.queries()["op9_pii"](spark, "/root/testdata/sf0.001").collect()}
    hits = 0
    for row in table("documents").collect():
        spans = plain_base(row.text)
        hits += len(spans)
        for kind in PLAIN:
            assert found[row.doc_id][f"n_{kind}"] == sum(s[0] == kind for s in spans)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert found[row.doc_id].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    assert hits
