import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from listenlens.session import ensure_checkpoint_dir, get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", 8, app_name="listenlens-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="listenlens-test-")


def write(path, name, text):
    p = os.path.join(path, name)
    with open(p, "w") as f:
        f.write(text)
    return p
