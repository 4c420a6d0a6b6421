import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from dwkit.session import get_spark

    s = get_spark("local[4]", 4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="dwkit-test-ckpt-")})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
