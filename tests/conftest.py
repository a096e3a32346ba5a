import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from meterline.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app_name="meterline-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="meterline-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="meterline-test-")
