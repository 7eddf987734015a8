import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pricelens.config import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("pricelens-tests", cores=4, shuffle_partitions=4)
    yield s


@pytest.fixture()
def warehouse(tmp_path):
    return str(tmp_path / "warehouse")
