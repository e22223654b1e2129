from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    os.chdir("/tmp")
    s = local_session("tests", cores=4, memory="4g")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def bed(spark):
    from ledgerloom.registry import bed as make

    return make(spark, SMALL)
