import pytest

from chemprobe.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", 4, spark__driver__memory="4g", spark__sql__autoBroadcastJoinThreshold="1m")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
