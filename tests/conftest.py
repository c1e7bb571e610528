from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def local_session(zone: str = "UTC"):
    from barloom.session import get_session

    spark = get_session(
        "tests", master="local[8,4]", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions=8,
        spark__driver__memory="8g", spark__sql__session__timeZone=zone,
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="run-"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()
