import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from usagelens.session import build_session
    warehouse = tempfile.mkdtemp(prefix="usagelens-warehouse-")
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="usagelens-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="usagelens-test-")


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR
