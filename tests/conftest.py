import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mastermill import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "mastermill-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__codegen__wholeStage="false",  # tiny inputs: compiling costs more than it saves
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_ts():
    return datetime(2024, 5, 8, 6, 30, tzinfo=timezone.utc)


def rows(df, *columns):
    """Sorted tuples of the named columns."""
    data = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in data.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
