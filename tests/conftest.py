import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from planpulse.session import build_session
    s = build_session("local[*]", 8, app_name="planpulse-tests")
    yield s
