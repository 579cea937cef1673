import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stayflow.session import build_session

    wh_dir = tempfile.mkdtemp(prefix="stayflow-test-wh-")
    s = build_session(app="stayflow-tests", cpus="*", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh_dir})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stayflow-test-")
