import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from closetops.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from closetops.oracle.check import duck
    return duck(SF_SMALL)
