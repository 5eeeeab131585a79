import pytest

from quillon.session import get_session, ship_package


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", "4")
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    return s
