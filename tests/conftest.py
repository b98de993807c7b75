from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marquee.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4,
        "marquee-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.streaming.stateStore.providerClass": (
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
            ),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    """Folder of the smallest generated tables; tests that need it skip without it."""
    if not Path(TESTDATA).exists():
        pytest.skip("generated tables are not available")
    return TESTDATA
