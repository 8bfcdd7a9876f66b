import pytest

from feedlake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "feedlake-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """The rows of ``df`` as tuples, sorted by text."""
    return sorted((tuple(row) for row in (df.select(*order) if order else df).collect()), key=repr)
