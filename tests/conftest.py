import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("SALESMART_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from salesmart.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()
