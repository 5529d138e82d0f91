import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripflow.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8, app_name="tripflow-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh scratch folder per test (tests run on one machine)."""
    return str(tmp_path)
