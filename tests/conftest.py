import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vatio.session import get_session
    s = get_session(os.environ.get("TEST_MASTER", "local[4]"), app="vatio-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def models(spark):
    from vatio.plans.pipeline import Models
    return Models.from_testdata(spark, SF_SMALL)
