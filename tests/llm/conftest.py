import pytest


@pytest.fixture(scope="session")
def shared(tmp_path_factory):
    return tmp_path_factory.mktemp("shared")


@pytest.fixture(autouse=True)
def checkpoint_folder(spark, shared):
    """A folder for written tables, where the session names none."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", f"file://{shared}")


# Rows every operator must bear: no text, no words, repeated rows and ids, ties, a long text, clashing columns.
HARD_ROWS = [
    (1, "one two three four five six seven eight", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
    (4, " \t\n ", "en", "a"), (None, "no id here at all my friend", "en", "a"), (None, None, None, "b"),
    (5, "same same same", "de", "a"), (5, "same same same", "de", "a"), (6, "same same same", "de", "a"),
    (7, "é😀 ß Σ 日本 <|endoftext|> </s> [INST]", "xx", "b"), (8, "word " * 40_000, "en", "a"),
]


@pytest.fixture(scope="session")
def hard(spark):
    """HARD_ROWS with extra columns named like what operators add."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, start long, h string, n long"
    rows = [(*r, len(r[1] or ""), 0.5, 3, "x", 1) for r in HARD_ROWS]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (8, None, None), (None, 1, 1), (6, 1, 0)],
                                 "doc_id long, quality int, toxic int")
