import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from houses import HOUSE_SCHEMA, make_houses, to_spark  # noqa: E402
from tessera import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, app="tessera-tests", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture
def houses(spark):
    return to_spark(spark, make_houses(), HOUSE_SCHEMA)
