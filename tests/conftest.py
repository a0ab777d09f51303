import pytest

from tessera.session import local_session, ship


@pytest.fixture(scope="session")
def spark():
    return ship(local_session(8, 8, "6g"))
