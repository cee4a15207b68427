import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.plans.session import local_session  # noqa: E402

SMOKE_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="basketry-tests", driver_memory="8g")
    yield s


@pytest.fixture(scope="session")
def sf():
    return SMOKE_SF
