import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from reelmart.session import build_session
    # tests name their own shared folder; jobs only read the setting
    ckpt = tempfile.mkdtemp(prefix="reelmart-ckpt-")
    s = build_session("local[4]", 8, app_name="reelmart-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
