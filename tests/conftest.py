import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from altimart.session import local_session

    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    from compare import open_tables

    return open_tables(TINY)
