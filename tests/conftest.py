import pytest

from marquee.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "marquee tests",
        master="local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled=False,
        spark__driver__memory="4g",
        spark__sql__session__timeZone="UTC",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
