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
    from refinery.session import get_session
    s = get_session("refinery-tests", master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="refinery-wh-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh folder below the session's checkpoint root."""
    from refinery.session import scratch_path
    return scratch_path(spark, "test")
