import pytest

from titlelabels.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, memory="6g")
    yield session
    session.stop()
