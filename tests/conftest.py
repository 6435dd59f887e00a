import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from hostlake.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="hostlake-tests")
    yield s


@pytest.fixture()
def scratch(spark):
    from hostlake.session import scratch_dir

    def make(name="t"):
        return scratch_dir(spark, name)
    return make
