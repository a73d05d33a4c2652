import os

os.environ.setdefault("TZ", "UTC")

import pytest

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
