import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from corpusgate.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
