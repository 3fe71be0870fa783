import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shiftwise.session import checkpoint_dir, get_session

    s = get_session("local[*]", 8, app="shiftwise-tests")
    # tests only: no shared checkpoint folder is configured here
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="shiftwise-ckpt-"))
    yield s
