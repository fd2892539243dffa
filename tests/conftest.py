import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("KESTREL_TEST_SF", SF_SMALL)


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=8, app_name="kestrel-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def views(spark):
    from kestrel.plans.fixtures import views as _views
    return _views(spark, SF_SMALL)
