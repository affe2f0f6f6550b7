import pytest

from tabwright.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("llm-tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
