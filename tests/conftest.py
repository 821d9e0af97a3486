import pytest

from tapesh.runtime import session


@pytest.fixture(scope="session")
def spark():
    return session("local[4]", 4)
