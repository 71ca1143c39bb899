import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.versions import Lake
from tidemark.session import build_session, tune


@pytest.fixture(scope="session")
def spark():
    session = tune(build_session(8, "tests", partitions=8))
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A fresh folder per test; local mode only."""
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, f"{folder}/lake")
