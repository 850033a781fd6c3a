import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from grainframe.session import build_session, drop_scratch  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__ui__enabled="false", spark__driver__memory="6g",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=tmp_path_factory.mktemp("shared").as_uri(),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return TESTDATA
