import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stratus.session import get_session

    d = tempfile.mkdtemp(prefix="stratus-test-ckpt-")
    s = get_session("local[4]", 4, app_name="stratus-tests", extra={"spark.checkpoint.dir": d})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stratus-test-")
