import random
from collections import Counter

import numpy as np
import pytest

from stallbook.llm import queries
from stallbook.llm.decontaminate import RADIUS, Benchmark, Hashes, Size, contaminated

SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in (p.strip(SIGNS) for p in lowered.split()) if w]


def plain_shingles(words, width):
    return [tuple(words[k:k + width]) for k in range(len(words) - width + 1)]


def plain_found(text, items):
    """Best similarity of every item over all windows of its size, in shingles as wide as the item allows."""
    words, found = plain_words(text), {}
    for key, item in items:
        item = plain_words(item)
        width = min(5, len(item))
        document, wanted = plain_shingles(words, width), plain_shingles(item, width)
        if not item or not document:
            continue
        size, wanted = len(wanted), Counter(wanted)
        length = min(size, len(document))
        for start in range(len(document) - length + 1):
            have = Counter(document[start:start + length])
            both = sum((wanted & have).values())
            if both and both / (size + length - both) >= 0.8 and both / (size + length - both) > found.get(key, (0,))[0]:
                found[key] = both / (size + length - both), start
    return found


def found(benchmark, text):
    return {benchmark.keys[n]: value for n, value in benchmark.found_in(text).items()}


@pytest.mark.parametrize("seed", range(15))
def test_same_as_comparing_everything(seed):
    chance = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(chance.choice(vocabulary) for _ in range(chance.randrange(1, 60)))) for k in range(30)]
    items += [(100, None), (101, ""), (102, "..."), (103, items[0][1]), (104, "same " * 30)]
    benchmark = Benchmark(items)
    for _ in range(8):
        parts = []
        for _ in range(4):
            parts += [chance.choice(vocabulary) for _ in range(chance.randrange(30))]
            leaked = plain_words(chance.choice(items)[1])
            for _ in range(chance.randrange(3)):
                if leaked:
                    leaked[chance.randrange(len(leaked))] = "changed"
            parts += leaked
        text = " ".join(p.title() + chance.choice(["", "", ",", ".\n"]) for p in parts)
        assert found(benchmark, text) == plain_found(text, items)


def test_index_is_complete():
    generator = np.random.default_rng(1)
    prints = generator.integers(0, 1 << 64, 300, np.uint64)
    size = Size()
    size.index(prints.tolist())
    queries_ = prints[:100] ^ (np.uint64(1) << generator.integers(0, 64, (20, 100)).astype(np.uint64)).sum(0, np.uint64)
    window, item = size.near(queries_)
    expected = np.bitwise_count(queries_[:, None] ^ prints[None, :]) <= RADIUS
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*(side.tolist() for side in np.nonzero(expected))))


def test_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""),
                                   (None, "no id"), (4, "x" * 5000), (5, "wordy " * 100)], "item_id long, text string")
    rows = contaminated(odd_documents, items).collect()
    assert sorted(((r.id, r.item_id) for r in rows), key=repr) == \
        sorted([(1, 1), (1, 1), (None, None), (10, 4), (11, 5)], key=repr)
    assert contaminated(no_documents, items).collect() == []
    assert contaminated(odd_documents, items.where("false")).collect() == []


def test_items_in_turns(spark, table, monkeypatch):
    from stallbook.llm import decontaminate

    whole = {tuple(r) for r in contaminated(table("documents"), table("benchmark")).collect()}
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    assert {tuple(r) for r in contaminated(table("documents"), table("benchmark")).collect()} == whole


def test_a_repeated_item_fills_no_turn(spark, monkeypatch):
    """A text under a third of the ids is sent once, and a turn is written before the next is fetched."""
    from stallbook.llm import decontaminate

    texts = [" ".join(f"w{k}x{n}" for n in range(12)) for k in range(150)]
    items = spark.createDataFrame([(n, texts[0]) for n in range(900)] + [(1000 + k, text) for k, text in enumerate(texts)],
                                  "item_id long, text string")
    documents = spark.createDataFrame([(1, f"before {texts[0]} after"), (2, texts[7])], "doc_id long, text string")
    done, map_rows, pinned = [], decontaminate.map_rows, decontaminate.pinned

    def sent(*columns, setup):
        done.append(len(setup().keys))
        return map_rows(*columns, setup=setup)

    def written(df):
        if "similarity" in df.columns:
            done.append("written")
        return pinned(df)

    monkeypatch.setattr(decontaminate, "map_rows", sent)
    monkeypatch.setattr(decontaminate, "pinned", written)
    monkeypatch.setattr(decontaminate, "ITEMS", 100)
    found = contaminated(documents, items)
    assert done[1::2] == ["written"] * 2 and sum(done[::2]) == 150 and max(done[::2]) <= 100
    assert sorted((r.id, r.item_id, r.start_word) for r in found.collect()) == \
        [(1, n, 1) for n in [*range(900), 1000]] + [(2, 1007, 0)]


def test_query(spark, table):
    rows = queries.queries()["op10_decontaminate"](spark, "/root/testdata/sf0.001").collect()
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    expected = {(d.doc_id, key): value for d in table("documents").collect()
                for key, value in plain_found(d.text, items).items()}
    assert {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in rows} == expected
    assert expected


def test_words():
    assert len(Hashes().words("a, b. -- c!")) == 3 and not len(Hashes().words(" -- "))


def test_short_items_are_found_inside_documents():
    items = [(1, "one"), (2, "Two three"), (3, "four, five six"), (4, "seven eight nine ten"), (5, "never there")]
    benchmark = Benchmark(items)
    text = "zero ONE two three. four five six! seven eight nine ten eleven one"
    assert found(benchmark, text) == {1: (1.0, 1), 2: (1.0, 2), 3: (1.0, 4), 4: (1.0, 7)} == plain_found(text, items)
    assert found(benchmark, "two") == found(benchmark, "three two") == found(benchmark, None) == {}


def test_many_items_of_one_size(monkeypatch):
    """Few pairs at once give the same."""
    from stallbook.llm import decontaminate

    generator = np.random.default_rng(3)
    items = [(k, " ".join(map(str, generator.integers(0, 40, 12)))) for k in range(200)]
    text = " ".join(item for _, item in items[:40])
    benchmark = Benchmark(items)
    whole = found(benchmark, text)
    monkeypatch.setattr(decontaminate, "PAIRS", 500)
    assert found(benchmark, text) == whole and len(whole) >= 40


def test_documents_go_by_themselves_alone(spark):
    """Rows are told apart by more than their id, and columns of any name come back."""
    documents = spark.createDataFrame(
        [(1, "an item to find", 5, 7, 9), (1, "something else", 6, 8, 10), (None, "holds an item to find here", 1, 1, 1),
         (None, None, 2, 2, 2), (2, "something else", 3, 3, 3)],
        "doc_id long, text string, __row int, r1 int, id int")
    items = spark.createDataFrame([(1, "an item to find")], "item_id long, text string")
    kept = queries.without_benchmark(documents, items)
    assert kept.columns == documents.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [(1, "something else", 6, 8, 10), (None, None, 2, 2, 2), (2, "something else", 3, 3, 3)], key=repr)
    each = queries.one_of_each_group(documents)
    assert each.columns == documents.columns
    left = sorted(map(tuple, each.collect()), key=repr)
    assert (1, "an item to find", 5, 7, 9) in left and (2, "something else", 3, 3, 3) not in left
    assert (1, "something else", 6, 8, 10) in left
