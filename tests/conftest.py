import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import local_session

    session = local_session("tidewatch-tests", cores="4", partitions=2)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def policies(spark, folder):
    from tidewatch.sources.tables import stored_policies

    return stored_policies(spark, folder, batch_rows=250)
