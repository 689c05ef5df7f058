import pytest

from docketloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, "docketloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
