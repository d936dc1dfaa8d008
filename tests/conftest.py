import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gripe.session import get_spark

    s = get_spark("gripe-tests", master="local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gripe-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
