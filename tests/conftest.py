import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from bench import session
    from weighbridge.session import tune

    return tune(session(8))


@pytest.fixture
def store(spark, tmp_path):
    from weighbridge.sources.tables import Store

    return Store(spark, str(tmp_path / "store"))
