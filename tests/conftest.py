import pytest

from spanloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
