import pytest

from . import corpus


@pytest.fixture(scope="session")
def rows():
    return corpus.texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return corpus.frame(spark, rows).cache()


@pytest.fixture(scope="session")
def odd_docs(spark, rows):
    """With repeated rows and rows without id."""
    return corpus.frame(spark, rows, corpus.repeated(rows)).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
