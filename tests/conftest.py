import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from shopweave.session import Workspace, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "6g", "tests")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    return Workspace(spark, str(tmp_path))


@pytest.fixture(scope="session")
def sf_dir():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip(f"no test data at {path}")
    return path
