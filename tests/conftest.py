import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="strata-tests-")
    session = build_session(
        "local[*]", app_name="strata-tests", shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
