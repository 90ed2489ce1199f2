import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import build_session
    scratch = tempfile.mkdtemp(prefix="tidewatch-tests-")
    s = build_session("local[4]", app="tidewatch-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.local.dir": scratch})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidewatch-case-")
