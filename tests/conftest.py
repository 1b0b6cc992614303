import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cellar.session import get_session
    s = get_session("local[*]", app="cellar-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cellar-test-ckpt-"))
    yield s
    from cellar.session import release_runs
    release_runs(s)
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cellar-test-")
