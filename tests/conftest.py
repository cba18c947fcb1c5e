import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pitwall.session import get_spark
    scratch = tempfile.mkdtemp(prefix="pitwall-test-")
    s = get_spark("local[4]", 4, app_name="pitwall-tests",
                  extra={"spark.local.dir": scratch,
                         "spark.checkpoint.dir": f"{scratch}/checkpoints"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("test data not present")
    return SMALL
