import random
import re
import time

from pyspark.sql import functions as F

from stallbook.llm import lines, queries


def near(x, y):
    if len(x) < len(y):
        x, y = y, x
    if min(len(x), len(y)) < lines.LEAST_WORDS:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) <= 1
    return len(x) == len(y) + 1 and any(x[:i] + x[i + 1:] == y for i in range(len(x)))


def plain(rows):
    """Texts without their repeated lines, by comparing all lines; rows are (order, text) in order."""
    seen, results = [], []
    for text in rows:
        if text is None:
            results.append(None)
            continue
        kept = []
        for line in text.split("\n"):
            words = line.split()
            if words and any(words == other or near(words, other) for other in seen):
                seen.append(words)
                continue
            if words:
                seen.append(words)
            kept.append(line)
        results.append("\n".join(kept))
    return results


def test_same_as_comparing_all_lines(spark):
    chance = random.Random(3)
    base = [[chance.choice("abcdefgh") * chance.randrange(1, 3) for _ in range(chance.randrange(1, 30))] for _ in range(40)]
    base += [["w"] * 30, ["w"] * 31, ["w"] * 12, ["w"] * 9, ["w"] * 10]
    texts = []
    for _ in range(120):
        text = []
        for _ in range(chance.randrange(6)):
            words = list(chance.choice(base))
            for _ in range(chance.choice([0, 0, 1, 1, 2])):
                at = chance.randrange(len(words))
                words[at:at + chance.choice([0, 1])] = chance.choice([[], ["new"], ["other"]])
                words = words or ["x"]
            text.append(chance.choice([" ", "  ", "\t"]).join(words) + chance.choice(["", " ", "\r"]))
        texts.append("\n".join(text + [""] * chance.randrange(3)))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row.doc_id: row.text for row in lines.dedup_lines(table).collect()}
    assert [found[k] for k in range(len(texts))] == plain(texts)


def test_neighbourhood(spark):
    words = [f"w{k}" for k in range(700)]
    row = spark.createDataFrame([(words,)], "words array<string>").select(lines._neighbourhood(F.col("words")).alias("n"),
                                                                          "words")
    shorter = [w for k, w in enumerate(words) if k != 300]
    other = spark.createDataFrame([(shorter,)], "words array<string>").select(lines._neighbourhood(F.col("words")).alias("n"))
    variants, whole = row.first().n.variants, other.first().n.whole
    assert len(set(variants)) == 700 and variants[300] == whole


def test_a_large_group_is_not_paired(spark):
    """Thousands of lines that differ in one word: the first stays."""
    table = spark.range(5000).selectExpr("id as doc_id", "concat('one two three four five six seven eight nine number ', id) as text")
    rows = lines.dedup_lines(table).where("text <> ''").collect()
    assert [row.doc_id for row in rows] == [0]


def test_odd_rows(spark, odd_documents, no_documents):
    rows = lines.dedup_lines(odd_documents)
    assert rows.columns == [*odd_documents.columns, "__lines_dropped"]
    found = rows.collect()
    assert len(found) == odd_documents.count()
    texts = [(row.doc_id, row.text) for row in found]
    assert texts.count((1, "the quick brown fox jumps over the lazy dog")) == 2   # repeated rows are one document
    assert (None, None) in texts and (5, "") in texts and (6, " \n\t ") in texts and (None, "no id") in texts
    assert lines.dedup_lines(no_documents).collect() == []


def test_a_text_of_many_lines(spark):
    """Work grows with the lines of a text, not with their square."""
    texts = ["same line\n" * 100_000, "\n".join(f"line {k % 50_000}" for k in range(100_000))]
    begun = time.time()
    one, two = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert (one.text, one["__lines_dropped"]) == ("same line\n", 99_999)
    assert (two.text, two["__lines_dropped"]) == ("\n".join(f"line {k}" for k in range(50_000)), 50_000)
    assert time.time() - begun < 60


def test_columns_of_any_name(spark):
    """Names that the operator uses itself: all but the count's come back as they were."""
    names = ["__row", "__gone", "row", "id", "numbers", "line", "h1", "r1", "first", "a.b"]
    rows = [(1, "x y\nx y", *range(len(names))), (2, "x y", *range(len(names)))]
    table = spark.createDataFrame(rows, ["doc_id", "text", *names]).withColumn("__lines_dropped", F.lit("old"))
    found = lines.dedup_lines(table)
    assert found.columns == table.columns
    assert sorted(map(tuple, found.collect())) == [(1, "x y", *range(len(names)), 1), (2, "", *range(len(names)), 1)]


def test_plan_is_native(spark, odd_documents):
    plan = lines.dedup_lines(odd_documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark, table):
    found = {row.doc_id: row for row in queries.queries()["op4_lines"](spark, "/root/testdata/sf0.001").collect()}
    rows = table("documents").orderBy("doc_id").collect()
    expected = plain([row.text for row in rows])
    assert {row.doc_id: text for row, text in zip(rows, expected)} == {key: row.text for key, row in found.items()}
    assert sum(row.lines_dropped for row in found.values()) > 0


def test_rows_without_a_part_stay(spark):
    """The bitmap never says no to a hash that is there, and says no to nearly all others, negative ones included."""
    there = spark.range(-500, 500).select(F.xxhash64("id").alias("key"))
    rows = spark.range(-500, 20_000).select("id", F.xxhash64("id").alias("key"))
    found = {row.id for row in rows.where(lines._may_be_among(there, "key")).select("id").collect()}
    assert set(range(-500, 500)) <= found and len(found) < 1100
    assert rows.where(lines._may_be_among(there.limit(0), "key")).isEmpty()


def test_joins_move_only_what_may_match(spark, monkeypatch):
    """Lines and keys without a partner are not moved for a join: every such join's larger side passes the bitmap."""
    asked = []
    real = lines._may_be_among
    monkeypatch.setattr(lines, "_may_be_among", lambda hashes, name="r1": asked.append(name) or real(hashes, name))
    texts = ["\n".join(f"w{n} " + " ".join(f"x{n}y{k}" for k in range(11)) for n in range(i, i + 3)) for i in range(4)]
    texts.append(texts[0].replace("x0y5", "other"))
    found = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [r.text for r in found.orderBy("doc_id").collect()] == plain(texts)
    assert sorted(asked) == ["h1", "h1", "h1", "key", "key", "r1", "r1", "v"]


def test_odd_white_space(spark):
    """A text without odd white space keeps its lines as they are; of any other, each line is its words and single spaces."""
    chance = random.Random(5)
    texts = ["".join(chance.choice(["a", "é", " ", "\u0085", " ", "\n", "\t", "\v", "\f", "\r"][:length])
                     for _ in range(chance.randrange(9))) for length in range(4, 11) for _ in range(300)]
    table = spark.createDataFrame(list(enumerate([*texts, None])), "id long, text string").select(
        "id", F.lit(0).cast("long").alias("r1"), F.lit(0).cast("long").alias("r2"), "text")
    found = {(row.id, row.number): row.line for row in lines._lines(table).collect()}
    expected = {}
    for k, text in enumerate(texts):
        for at, line in enumerate(text.split("\n")):
            words = [w for w in re.split("[ \t\v\f\r]+", line) if w]
            if words:
                expected[k, at] = " ".join(words)
    assert found == expected


def test_halves_of_lines_one_word_apart(spark):
    """Lines one word apart share a key; keys are made of all words of a half, in order."""
    chance = random.Random(6)
    rows = []
    for _ in range(400):
        words = [chance.choice(["a", "bb", "é"]) for _ in range(chance.randrange(10, 16))]
        other, at = list(words), chance.randrange(len(words))
        other[at:at + chance.choice([0, 1])] = ["new"]
        rows.append((" ".join(words), " ".join(other)))
    rows.append((" ".join("abcdefghijkl"), " ".join("axcdefghixkl")))
    table = spark.createDataFrame(rows, "x string, y string")
    keys = [lines._halves(F.col(c), F.size(F.split(c, " "))) for c in "xy"]
    *near, two = [row[0] for row in table.select(F.arrays_overlap(*keys)).collect()]
    assert all(near) and not two


def test_all_lines_are_read_without_regular_expressions(spark, monkeypatch):
    """What every text and line passes through searches for plain strings and keeps lines whole."""
    seen = []
    real = lines.pinned
    monkeypatch.setattr(lines, "pinned", lambda df: seen.append(df) or real(df))
    lines.dedup_lines(spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string"))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert seen[0].columns[-1] == "keys" and "substring_index" in plan
    assert "RLIKE" not in plan and "slice" not in plan and plan.count("split(") == 1
