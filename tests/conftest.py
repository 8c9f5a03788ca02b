from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tunemill.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
