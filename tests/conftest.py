import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session
    ckpt = tempfile.mkdtemp(prefix="quarry-test-ckpt-")  # tests only: no cluster checkpoint dir
    s = build_session("local[4]", app="quarry-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
