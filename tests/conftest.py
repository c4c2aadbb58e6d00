import os
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sluice.session import local_session

    warehouse = tempfile.mkdtemp(prefix="sluice-test-wh-")
    session = local_session("local[4]", "sluice-tests", **{"spark.sql.warehouse.dir": warehouse})
    # spark.checkpoint.dir is taken from the configuration; only when it is unset does
    # checkpoint_root create a local folder (local master only)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sluice-test-")
