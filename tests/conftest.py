import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from stratus.session import build_session
    s = build_session("local[8]", app="stratus-tests", shuffle_partitions=8, driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s


def D(x):
    return None if x is None else Decimal(str(x))
