from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from assayer.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(df) -> sorted list of plain tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect
