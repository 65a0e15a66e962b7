import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from bulwark.session import local_session

    return local_session(app="tests")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    from tools.check import connect

    return connect(SF)
