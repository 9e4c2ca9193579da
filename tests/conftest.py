import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from frameloom.session import local_session

    return local_session("tests", "4", 4)


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("the test tables aren't here")
    return DATA
