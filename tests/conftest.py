import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kickwx.session import build_session
    s = build_session("local[*]", 8, app="kickwx-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def marts_small(spark):
    from kickwx.plans.warehouse import marts_from_tables
    return marts_from_tables(spark, SF_SMALL)
