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
    from shiftline.session import get_session
    s = get_session("local[*]", 8, app_name="shiftline-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="shiftline-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def no_broadcast(spark):
    """The planner broadcasts nothing: every dimension counts as large."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shiftline-test-")
