import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shelfmatch.session import get_spark
    s = get_spark("local[4]", app="shelfmatch-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        # Tests only: no cluster checkpoint folder is configured here.
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shelfmatch-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="shelfmatch-test-")
