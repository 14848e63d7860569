import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from postlytics.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="postlytics-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="postlytics-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="postlytics-test-")
