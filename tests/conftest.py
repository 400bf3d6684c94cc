import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tezaur.session import local_session

    return local_session(4, 4, "4g")


@pytest.fixture(scope="session")
def sf_dir():
    return SF
