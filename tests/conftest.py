import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from telco_mart.session import get_spark, checkpoint_dir
    s = get_spark(app="telco_mart_tests", master="local[4]", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
