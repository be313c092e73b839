import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from barloom.session import local_session

    session = local_session(4, 4, "barloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(scope="session")
def con(data):
    from compare import connect

    return connect(data)
