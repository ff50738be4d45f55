import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from loomspan.session import build_session

    session = build_session("local[4]", 4, spark__driver__memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("LOOMSPAN_TEST_DIR", "/root/testdata/sf0.001")
