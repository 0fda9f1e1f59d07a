import os
import sys
import tempfile
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
BASE = datetime(2024, 1, 10, 12, 0, 0)


def at(minutes: float) -> datetime:
    return BASE + timedelta(minutes=minutes)


@pytest.fixture(scope="session")
def spark():
    from clearbid.session import build_session
    extra = {}
    from pyspark.sql import SparkSession
    if SparkSession.getActiveSession() is None:
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="clearbid-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=8, extra=extra)
    yield s


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="clearbid-test-")
