import pytest

from tablewright.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tablewright tests", cores=8)
    yield session
    session.stop()
