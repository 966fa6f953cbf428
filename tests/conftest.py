import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from finspark.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="finspark-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="finspark-test-ckpt-")})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="finspark-test-")
