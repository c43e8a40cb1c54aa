import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vendora.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), shuffle_partitions=4, memory="4g")
    yield session
    session.stop()
