import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(root / "checkpoints"),
        spark__sql__warehouse__dir=str(root / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, None first."""

    def collect(df, *cols):
        found = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) for v in r])

    return collect
