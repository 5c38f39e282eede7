import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, checkpoint_dir
    s = build_session("local[*]", 8, app_name="tidemark-tests")
    checkpoint_dir(s, tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidemark-test-")
