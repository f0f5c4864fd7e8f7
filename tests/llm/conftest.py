import random

import pytest

from barloom.session import new_session

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keys string, rep long, bucket int"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = new_session(
        "llm-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def prose(seed, n, words=120):
    random.seed(seed)
    return " ".join(f"{random.choice('bcdfglmnprst')}{random.choice('aeiou')}{random.randrange(words)}" for _ in range(n))


#: Copies, near copies, shared passages, repeats in one text, blanks, nulls, repeated rows, a long text, odd characters.
TEXTS = [
    prose(1, 80), prose(1, 80), prose(1, 80) + " tail", prose(2, 60), prose(2, 30) + " x " + prose(3, 40),
    prose(4, 25) + " " + prose(4, 25), "", None, " \n\t", "one two", "One TWO", "a " * 400, "é漢▁😀 " * 30 + prose(5, 20),
    prose(6, 3000), prose(6, 3000)[500:9000], prose(1, 80).upper(), "only\x00zero\x00bytes " * 20, "one two three four five",
]


@pytest.fixture(scope="session")
def texts():
    return TEXTS


def table(spark, texts):
    """Documents with ids falling apart from their order, one row twice, and columns whose names operators use themselves."""
    rows = [(i * 7 % 1000, t, None, "s", None, "k", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[3:4] + [(None, "no id", None, None, None, None, None, None)], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return table(spark, TEXTS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
