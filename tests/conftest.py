import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pulsegrid.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=4, app="pulsegrid-tests")
    yield s


SF = "/root/testdata/sf0.001"
