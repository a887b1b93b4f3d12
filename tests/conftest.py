import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from gridzonal import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="2000",
        spark__checkpoint__dir=str(shared),
        spark__sql__warehouse__dir=str(shared / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
