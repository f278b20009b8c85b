import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from msgtriage.session import get_session

    s = get_session(
        "local[4]",
        "msgtriage-tests",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="msgtriage-test-ckpt-")},
    )
    yield s
