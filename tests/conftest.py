import pytest

from tests.sparks import session


@pytest.fixture(scope="session")
def spark():
    yield session()
