import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from aerolith.session import build_session, scratch_root

    s = build_session(
        master="local[4]",
        shuffle_partitions=4,
        driver_memory="4g",
        extra={"spark.ui.showConsoleProgress": "false"},
    )
    scratch_root(s)  # tests: a private checkpoint dir when none is configured
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    return tempfile.mkdtemp(prefix="aerolith-test-")
