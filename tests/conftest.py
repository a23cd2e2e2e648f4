import pytest

from kitloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("kitloom-tests", "local[4]", 4, spark__driver__memory="3g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
