import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tierlake.session import local_session, release_scratch
    wh = tempfile.mkdtemp(prefix="tierlake-wh-")
    s = local_session("tierlake-tests", cpus="*", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    release_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tools.oracle_check import duck_con
    return duck_con(SF_SMALL)


@pytest.fixture()
def tmp(spark):
    from tierlake.session import scratch_path
    return scratch_path(spark, "test")
