import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from clickweave.session import get_session, work_dir
    s = get_session("local[4]", app="clickweave-tests", shuffle_partitions=4)
    if not s.conf.get("clickweave.work.dir", None):
        s.conf.set("clickweave.work.dir", tempfile.mkdtemp(prefix="clickweave-tests-"))
    work_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="clickweave-t-")
