import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import local_session

    session = local_session("tests", cores=8)
    yield session
    session.stop()


@pytest.fixture()
def store(spark, tmp_path):
    from millrace.tables import TableStore

    return TableStore(spark, f"{tmp_path}/tables")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    return SF_DIR
