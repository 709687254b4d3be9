import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallystream.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-")
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__checkpoint__dir=f"file://{folder}/shared", spark__sql__warehouse__dir=f"file://{folder}/warehouse",
        spark__driver__bindAddress="127.0.0.1", spark__driver__host="127.0.0.1")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return tmp_path.as_uri()
