import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from slicemill.session import build_session
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "2", "spark.driver.memory": "8g", "spark.sql.ansi.enabled": "true"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collect(df, *cols):
        return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)
    return collect
