import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from callweave.session import configure, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
