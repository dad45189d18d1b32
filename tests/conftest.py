import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from roadwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    """An instant in UTC from a time of day on 2024-01-01, or from a full date and time."""
    if len(text) <= 15 and ":" in text:
        text = f"2024-01-01 {text}"
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def utc_text(*names):
    """SQL for reading instants back as text."""
    return [f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {name}" for name in names]


def same_rows(left, right):
    names = sorted(left.columns)
    assert names == sorted(right.columns)
    left, right = left.select(*names), right.select(*names)
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0
