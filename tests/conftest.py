import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from colloquy.operators import models
    from colloquy.session import build_session
    # the checks hold for any number of boosting rounds; the reference's 100
    # are fitted by the registered queries outside the tests
    models.DEFAULT_PARAMS[models.BOOSTED_TREES]["maxIter"] = 8
    s = build_session("local[4]", app="colloquy-tests", shuffle_partitions=8)
    yield s
    s.stop()
