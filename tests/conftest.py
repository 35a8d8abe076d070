import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)


@pytest.fixture(scope="session")
def spark():
    from refillscope.session import build_session

    session = build_session(master="local[4]", shuffle_partitions=4, app_name="refillscope-tests")
    yield session
    session.stop()
