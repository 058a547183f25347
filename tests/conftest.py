import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tablesmith.session import checkpoint_dir, get_session
    s = get_session("local[*]", 8, extra={"spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tablesmith-ckpt-")})
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tablesmith-test-")
