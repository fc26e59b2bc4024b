from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from tilelake import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            # Small test data must still spread over several slices.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
