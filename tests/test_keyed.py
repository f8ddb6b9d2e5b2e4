import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from stallbook.sources import commits
from stallbook.sources.keyed import KeyedTable

SCHEMA = "id long, name string, n int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    df = spark.createDataFrame([(i, f"name {i}", i * 10) for i in range(200)], SCHEMA)
    return KeyedTable.create(df, str(tmp_path / "t"), "id", 16)


def test_merge_updates_and_inserts(spark, table):
    new = spark.createDataFrame([(3, "three", 1), (1000, "new", None), (None, "no key", 5)], SCHEMA)
    table.merge(new)
    expected = {i: (i, f"name {i}", i * 10) for i in range(200)} | {3: (3, "three", 1), 1000: (1000, "new", None),
                                                                     None: (None, "no key", 5)}
    assert rows(table.read()) == sorted(expected.values(), key=repr)
    table.merge(spark.createDataFrame([(None, "again", 6)], SCHEMA))
    assert table.read().where("id IS NULL").collect() == [(None, "again", 6)]


def test_merge_of_some_columns_keeps_the_others(spark, table):
    table.merge(spark.createDataFrame([(7, None), (500, 1)], "id long, n int"))
    assert rows(table.read().where("id IN (7, 500)")) == [(500, None, 1), (7, "name 7", None)]


def test_without_insert_no_row_is_added(spark, table):
    table.merge(spark.createDataFrame([(7, "seven", 7), (500, "x", 1)], SCHEMA), insert=False)
    assert table.read().count() == 200 and table.read().where("id = 7").first()["name"] == "seven"


def test_untouched_buckets_keep_their_files(spark, table):
    before = table.files()
    touched = table.merge(spark.createDataFrame([(3, "three", 1), (4, "four", 1)], SCHEMA))
    after = table.files()
    assert 0 < len(touched) <= 2
    untouched = {name: size for name, size in before.items() if int(name.split("/")[0]) not in touched}
    assert untouched and untouched.items() <= after.items()
    assert all(name not in after for name in before.keys() - untouched.keys())


def test_only_touched_buckets_are_read(spark, table):
    state = commits.read(spark, table.path)
    assert len(table._read(state, [1, 2]).inputFiles()) <= 2 < len(table.read().inputFiles())


def test_a_key_twice_is_an_error_and_changes_nothing(spark, table):
    before = table.files()
    with pytest.raises(ValueError, match="more than once"):
        table.merge(spark.createDataFrame([(3, "a", 1), (3, "b", 1)], SCHEMA))
    with pytest.raises(ValueError, match="not in the table"):
        table.merge(spark.createDataFrame([(3, 1.0)], "id long, price double"))
    with pytest.raises(ValueError, match="own"):
        KeyedTable.create(spark.createDataFrame([(1, 1)], "id int, _bucket int"), table.path + "2", "id", 4)
    assert table.files() == before
    assert table.merge(spark.createDataFrame([], SCHEMA)) == []


def test_of_two_writers_one_fails_loudly(spark, table, monkeypatch):
    """The second begins from the same commit and finishes after the first."""
    other = KeyedTable(spark, table.path)
    real, began = commits.commit, []

    def late(*args):
        if not began:
            began.append(True)
            other.merge(spark.createDataFrame([(3, "first", 1)], SCHEMA))
        real(*args)

    monkeypatch.setattr(commits, "commit", late)
    with pytest.raises(commits.Conflict):
        table.merge(spark.createDataFrame([(3, "second", 2)], SCHEMA))
    assert table.read().where("id = 3").first()["name"] == "first"
    assert table.vacuum(timedelta(0)) == []                     # the loser removed what it wrote


def test_vacuum_removes_what_no_commit_names(spark, table):
    table.merge(spark.createDataFrame([(i, "all", 0) for i in range(200)], SCHEMA))
    expected = rows(table.read())
    assert table.vacuum() == [] and len(table.vacuum(timedelta(0))) == 1
    assert rows(table.read()) == expected


def test_empty_table(spark, tmp_path):
    empty = KeyedTable.create(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), "id", 4)
    assert empty.read().collect() == [] and empty.read().columns == ["id", "name", "n"]
    empty.merge(spark.createDataFrame([(1, "a", 1)], SCHEMA))
    assert rows(empty.read()) == [(1, "a", 1)]
    with pytest.raises(commits.Conflict):
        KeyedTable.create(spark.createDataFrame([], SCHEMA), empty.path, "id", 4)


def test_commits_are_numbered_once(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(RuntimeError, match="nothing is committed"):
        commits.read(spark, root)
    commits.commit(spark, root, 1, {"a": "é"})
    commits.commit(spark, root, 2, {"a": 2})
    assert (commits.last(spark, root), commits.read(spark, root, 1), commits.read(spark, root)) == (2, {"a": "é"}, {"a": 2})
    with pytest.raises(commits.Conflict):
        commits.commit(spark, root, 2, {"a": 3})


def test_a_taken_number_is_found_by_the_rename_itself(spark, tmp_path, monkeypatch):
    """Also when both writers looked before either committed."""
    root = str(tmp_path)
    monkeypatch.setattr(commits, "last", lambda *_: 0)
    commits.commit(spark, root, 1, {"who": "one"})
    with pytest.raises(commits.Conflict):
        commits.commit(spark, root, 1, {"who": "two"})
    assert json.loads((tmp_path / "_commits" / f"{1:012d}.json").read_text()) == {"who": "one"}
    assert [p.name for p in (tmp_path / "_commits").iterdir() if "draft" in p.name and not p.name.startswith(".")] == []
