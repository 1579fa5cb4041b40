import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeshore.session import local_session

    s = local_session(4, shuffle_partitions=8, app="lakeshore-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from lakeshore.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)
    return make
