import os

import pytest

from lexforge.session import local_session

DATA = os.environ.get("LEXFORGE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"
