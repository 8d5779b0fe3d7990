import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from purchase_signals.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=8, shuffle_partitions=8, app="purchase_signals_tests")
    yield s
    s.stop()
