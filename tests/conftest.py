import pytest

from barloom.session import new_session
from barloom.sources.catalog import catalog_from_map


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = new_session(
        "barloom-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.driver.extraJavaOptions": "-Dderby.system.home=/tmp",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def catalog(spark):
    return catalog_from_map(
        spark,
        {
            "AAA": {"id": "aaausd", "name": "A", "earliest_date": "2025-01-01", "location": "USA"},
            "BBB": {"id": "bbbusd", "name": "B", "earliest_date": "2025-01-03", "location": "UK"},
            "007": {"id": "seven", "name": "Seven", "earliest_date": "2025-01-01", "location": "UK"},
        },
    )
