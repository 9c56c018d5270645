import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medalake.session import get_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="medalake-tests", shuffle_partitions=4)
    # tests set their own checkpoint folder only when the session has none
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="medalake-test-ckpt-"))
    yield s


@pytest.fixture
def root(spark, request):
    return shared_dir(spark, "tests", request.node.name[:40])
