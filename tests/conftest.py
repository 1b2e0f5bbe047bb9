import pytest

from quillspark.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session()
    s.sparkContext.setLogLevel("ERROR")
    yield s
