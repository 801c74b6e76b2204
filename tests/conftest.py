import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from carelens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "carelens-tests",
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tmp_path_factory.mktemp("shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect
