import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from propyield.session import local_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="propyield-tests")
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh folder below the session's shared folder."""
    return scratch_path(spark, "test")
