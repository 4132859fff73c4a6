import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from candlewick.session import get_session
    ckpt = tempfile.mkdtemp(prefix="candlewick-test-ckpt-")
    s = get_session("local[*]", app="candlewick-tests", shuffle_partitions=8,
                    spark__checkpoint__dir=ckpt)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="candlewick-test-")
