import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "scripts")]

from starloom.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test data in {DATA}")
    return DATA


@pytest.fixture
def rows(spark):
    """Rows of a frame as plain tuples, sorted."""
    def take(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return take
