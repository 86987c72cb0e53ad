import pytest

from folioforge.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, memory="4g")
    yield s
    s.stop()
