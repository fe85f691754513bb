import pytest

from factorloom.plans.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, partitions=4, memory="3g", spark__default__parallelism="4")
    yield s
    s.stop()
