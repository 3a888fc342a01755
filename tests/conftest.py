import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sparkfit.session import build_session, clear_scratch
    s = build_session("local[4]", shuffle_partitions=8, app_name="sparkfit-tests")
    yield s
    clear_scratch(s)
    left = os.listdir(s.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    s.stop()
    assert "sparkfit-scratch" not in left
