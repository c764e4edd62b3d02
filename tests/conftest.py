import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from carepath.session import get_session
    s = get_session("local[4]", "carepath-tests", shuffle_partitions=4)
    yield s
    s.stop()


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
