import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from livemart.session import build_session, checkpoint_root
    s = build_session("local[*]", 8)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from livemart.session import scratch_path
    return scratch_path(spark, "tests")
