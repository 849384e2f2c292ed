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
    from claimflow.session import build_session
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    # tests own the shared folder only because no cluster names one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="claimflow-test-"))
    yield s
    s.stop()
