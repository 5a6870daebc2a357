import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lodestar.session import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="lodestar-tests")
    yield s
    s.stop()


@pytest.fixture()
def store(spark):
    from lodestar.session import work_dir
    from lodestar.sources.store import Store

    return Store(spark, work_dir(spark, "test-store"))
