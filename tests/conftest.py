import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import local_session, ship_package

    session = local_session(4, 4, "4g")
    session.sparkContext.setLogLevel("OFF")
    yield ship_package(session)
    session.stop()
