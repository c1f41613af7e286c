import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stintlake.functions.ordered import SplitPolicy, set_default_policy
from stintlake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "stintlake-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.streaming.metricsEnabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tight():
    """A policy under which even small groups are cut."""
    policy = SplitPolicy(max_rows=20, sample_every=1)
    previous = set_default_policy(policy)
    yield policy
    set_default_policy(previous)
