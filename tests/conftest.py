import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from sparkmart.session import get_session

    s = get_session("local[4]", app_name="sparkmart-tests", shuffle_partitions=8,
                    driver_memory="4g")
    yield s


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
