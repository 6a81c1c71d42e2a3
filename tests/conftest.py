import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"
SF_SMALL = f"{TESTDATA}/sf0.001"
SF_CHECK = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starlens.session import build_session, checkpoint_root

    session = build_session("local[*]", app_name="starlens-tests", shuffle_partitions=8)
    # Tests set their own shared folder only when the session names none.
    checkpoint_root(session, fallback=tempfile.mkdtemp(prefix="starlens-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="starlens-test-")
