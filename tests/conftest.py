import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8)
    # tests own the session, so they may set the checkpoint folder themselves
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-test-ckpt-"))
    yield s
    s.stop()
