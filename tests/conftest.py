import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from eventlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("eventlake-tests", "local[8]", spark__sql__shuffle__partitions="8",
                            spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
