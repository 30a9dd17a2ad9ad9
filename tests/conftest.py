import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tideline.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tideline-test-ckpt-")
    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.streaming.stateStore.providerClass":
                                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="tideline-test-")
