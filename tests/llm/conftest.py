import pytest

#: Texts that every operator must take: null, empty, no letters, repeated rows, a long one, other scripts.
ODD = [(1, None), (2, ""), (3, "   \n\t"), (4, "12 34 -- !!"), (5, "same words here again and again today"), (6, "same words here again and again today"), (7, "word " * 30_000), (8, "Ünïcödé ßtraße 漢字 😀 İstanbul Σίσυφος"), (9, "a"), (10, "² ½ ٣"), (11, "same words here\u2028and again and again today")]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts, with columns whose names clash with what operators make."""
    return spark.createDataFrame([(i, t, 9.5, "x", 3) for i, t in ODD], "doc_id long, text string, score double, spans string, n int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
