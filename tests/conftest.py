import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))


@pytest.fixture(scope="session")
def spark():
    from adjudica.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()
