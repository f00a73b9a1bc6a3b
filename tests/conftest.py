import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakekit.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app_name="lakekit-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        # tests only: no shared checkpoint folder is configured locally
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakekit-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
