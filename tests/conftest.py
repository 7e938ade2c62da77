import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martline.session import local_session
    ckpt = tempfile.mkdtemp(prefix="martline-test-")
    s = local_session("*", shuffle_partitions=8, app_name="martline-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from martline.session import scratch_path
    return lambda name: scratch_path(spark, name)
