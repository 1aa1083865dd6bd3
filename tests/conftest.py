import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelens.schema import PAGE_SCHEMA  # noqa: E402
from pricelens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="pricelens-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def pages_a(spark):
    from tests.fixtures import site_a_pages
    return spark.createDataFrame(site_a_pages(), PAGE_SCHEMA)


@pytest.fixture(scope="session")
def pages_b(spark):
    from tests.fixtures import site_b_pages
    return spark.createDataFrame(site_b_pages(), PAGE_SCHEMA)
