import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls, empty, blank, short and long texts, ties and repeats."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(6000))
    base = " ".join(f"base{i}" for i in range(120))
    near = base.replace("base60 ", "other ")
    shared = " ".join(f"common{i}" for i in range(60))
    rows = [
        (0, base, "a", 1),
        (1, near, "a", 1),
        (2, base, "b", 1),
        (2, base, "b", 1),
        (3, None, None, 1),
        (4, "", "a", 1),
        (5, " \n\t ", "b", 1),
        (6, "word", None, 1),
        (7, "two words", "a", 1),
        (8, "two words", "c", 1),
        (9, long, "c", 1),
        (10, "start of ten " + shared + " end of ten", "c", 1),
        (11, "eleven begins here " + shared + " and ends", "b", 1),
        (12, "<|endoftext|> special's we'll  text \n\n x", "b", 1),
        (None, "no id at all", "a", 1),
    ]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING, key INT")


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
