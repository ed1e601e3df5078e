import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))



@pytest.fixture(scope="session")
def spark():
    from tidings.session import build_session
    # tests run on a local master, so they name their own checkpoint folder
    s = build_session("local[*]", 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidings-test-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidings-scratch-")
