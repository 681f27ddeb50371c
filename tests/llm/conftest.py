import pytest

LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
BASE = " ".join(f"word{i}" for i in range(60))
#: (doc_id, text): nulls, empty, blank and very long texts, ties, repeats, copies.
ROWS = [
    (1, BASE), (2, BASE.upper()), (3, BASE + " extra"), (4, None), (5, ""), (6, "   \n\t "),
    (7, "Short one"), (8, "short ONE"), (9, LONG), (10, LONG + " tail"), (11, "Ä é ß 中文 😀"), (12, "ä é ß 中文 😀"),
    (None, BASE), (None, None), (None, "only here without a number"), (13, "twice the same"), (13, "twice the same"),
    (14, "x" * 30_000), (15, "<|endoftext|> in a text </s> <s>"), (16, "12345 67890"), (17, "!!! ??? ..."),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd rows with extra columns whose names clash with internal ones."""
    rows = [(i, t, "en" if t and k % 2 else None, "src", k, "n", "keep", f"run{k}", 1.0, [k])
            for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, id int, n string, keep string, "
              "run string, score double, ids array<int>").repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def documents(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
