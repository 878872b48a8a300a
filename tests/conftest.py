import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starload.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, shuffle_partitions=4, app="starload-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def wh_root(tmp_path):
    return str(tmp_path / "warehouse")
