import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logweir.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="logweir-tests")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="logweir-test-")


@pytest.fixture
def texts(spark):
    """Record texts → a frame with one ``value`` column."""
    return lambda *values: spark.createDataFrame([(value,) for value in values], "value string")
