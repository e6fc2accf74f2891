from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "wardflow-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="wardflow-tests-"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="wardflow-warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("WARDFLOW_TEST_TABLES", "/root/testdata/sf0.01")
