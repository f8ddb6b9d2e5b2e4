import hashlib
import random

import pytest

from stallbook.llm import chat, queries

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", " [/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[SAYS]", "[/ROLE]", "\\", "<",
           "[", "/", "s>", "\n", " ", "x", "", "é𝄞"]


@pytest.mark.parametrize("seed", range(30))
def test_template_is_reversible(seed):
    chance = random.Random(seed)
    turns = [(chance.choice(["user", "assistant", "system", "tool]", "<s>", ""]),
              "".join(chance.choice(CONTROL) for _ in range(chance.randrange(12)))) for _ in range(20)]
    text, spans = chat.formatted(turns)
    assert chat.parsed(text) == turns
    assert [chat.unescaped(text[a:b]) for a, b in spans] == [words for role, words in turns if role == "assistant"]


def plain_paths(messages):
    """{(tree, leaf): (score, ids from the root)} by walking up from every leaf."""
    nodes = {(m[0], m[1]): m for m in messages}
    answered = {(m[0], m[2]) for m in messages if (m[0], m[2]) in nodes}
    found = {}
    for tree, message in nodes:
        if (tree, message) in answered:
            continue
        path, at = [], (tree, message)
        while at in nodes and at not in path:
            path.append(at)
            at = (tree, nodes[at][2])
        if at not in nodes:
            found[tree, message] = (sum(nodes[n][5] or 0 for n in path), [n[1] for n in reversed(path)])
    return found


def tree_rows(seed):
    chance = random.Random(seed)
    rows = []
    for tree in (1, 2, 3, None):
        size = chance.randrange(1, 60)
        for message in range(size):
            parent = chance.choice([message - 1, chance.randrange(message)]) if message else chance.choice([None, 999])
            rows.append((tree, message, parent, chance.choice(["user", "assistant", None]), f"{tree} {message}",
                         chance.choice([None, 0.0, 1.0, 2.0])))
    rows += [(4, 1, 2, "user", "circle", 1.0), (4, 2, 1, "user", "circle", 1.0), (4, 3, 2, "user", "hangs on it", 1.0),
             (5, 1, 1, "user", "its own answer", 0.0)]
    return rows


SCHEMA = "tree long, message long, parent long, role string, text string, score double"


@pytest.mark.parametrize("seed", [1, 2])
def test_paths(spark, seed):
    rows = tree_rows(seed)
    expected = plain_paths(rows)
    found = {}
    for row in chat.branches(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault((row.tree.tree, row.leaf), []).append((row.position, row.message, row["rank"]))
    assert {key: [m for _, m, _ in sorted(path)] for key, path in found.items()} == {k: p for k, (_, p) in expected.items()}
    for (tree, leaf), path in found.items():
        better = [l for (t, l), (score, _) in expected.items()
                  if t == tree and (-score, l) < (-expected[tree, leaf][0], leaf)]
        assert {rank for _, _, rank in path} == {len(better) + 1}


def test_best_path_is_formatted(spark):
    rows = tree_rows(3)
    expected = plain_paths(rows)
    texts = {(r[0], r[1]): (r[3] or "", r[4]) for r in rows}
    for row in chat.format_trees(spark.createDataFrame(rows, SCHEMA)).collect():
        best = min((-score, leaf) for (tree, leaf), (score, _) in expected.items() if tree == row.tree)
        assert row.leaf == best[1]
        assert chat.parsed(row.conversation) == [texts[row.tree, m] for m in expected[row.tree, row.leaf][1]]


def test_odd_turns(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 0, "assistant", ""),
            (2, 5, "assistant", "late"), (2, 1, "system", "x" * 100_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {row.tree: chat.parsed(row.conversation) for row in chat.format_trees(chat.as_trees(table)).collect()}
    assert found == {1: [("", "first"), ("user", ""), ("user", "")], None: [("assistant", "")],
                     2: [("system", "x" * 100_000), ("assistant", "late")]}


def test_empty_table(spark):
    assert chat.format_trees(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark, table):
    found = {row.conv_id: row for row in queries.queries()["op5_chat"](spark, "/root/testdata/sf0.001").collect()}
    expected = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for row in table("conversations").orderBy("conv_id", "turn").collect():
        expected.setdefault(row.conv_id, []).append((row.role, row.text))
    assert found.keys() == expected.keys()
    for key, turns in expected.items():
        row, trained = found[key], "".join(text for role, text in turns if role == "assistant")
        assert (row.n_turns, row.loss_chars) == (len(turns), len(trained))
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()
