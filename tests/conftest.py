import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tripfold.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tripfold-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def hot_floor(spark):
    """Lets small groups count as hot."""
    from tripfold.operators.skew import FLOOR_CONF

    spark.conf.set(FLOOR_CONF, "1")
    yield
    spark.conf.unset(FLOOR_CONF)
