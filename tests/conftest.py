from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from gritstone.session import get_session

    session = get_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
        "spark.default.parallelism": "4",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
