import os
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [REPO, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from martlet.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4, app_name="martlet-tests",
                      extra={"spark.driver.memory": "4g",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="martlet-checkpoint-", dir="/tmp")})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="martlet-test-", dir="/tmp")
