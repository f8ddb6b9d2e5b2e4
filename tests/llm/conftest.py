import pytest

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="session")
def table(spark):
    """A table of the smallest scale by name."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, columns with clashing names."""
    rows = [(1, "the quick brown fox jumps over the lazy dog", "en"), (1, "the quick brown fox jumps over the lazy dog", "en"),
            (1, "another text under the same id", None), (None, "no id", "en"), (None, None, None), (4, None, "de"),
            (5, "", "en"), (6, " \n\t ", "en"), (7, "double  spaces \n and\r\nlines ", "fr"),
            (8, "<|endoftext|> and <|startoftext|>x<|endoftext|>", "en"), (9, "ÀÉ ñandú 漢字かな交じり文 ΑΣ'S é ﬁ İx", "xx"),
            (10, "x" * 5000, "en"), (11, "wordy " * 3000, "en"), (12, "\x1c\x85　​ a", "en"), (13, "'s 't it's 'S", "en")]
    return spark.createDataFrame([(i, t, l, 0, "c") for i, t, l in rows],
                                 "doc_id long, text string, id string, n int, component string")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
