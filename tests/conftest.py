import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from salesflow.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        # tests only: no shared checkpoint folder is configured here
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="salesflow-test-ckpt-"))
    yield s
