import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from millrace.plans.ordered import HOT_ROWS_CONF  # noqa: E402
from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_tasks(spark):
    """Treat groups of more than 20 rows as hot, so the sliced plans run."""
    spark.conf.set(HOT_ROWS_CONF, "20")
    yield
    spark.conf.unset(HOT_ROWS_CONF)


@pytest.fixture
def rows():
    """Sorted plain tuples of a DataFrame."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
