from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fleetfeatures.session import build_session
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.checkpoint.dir": str(base / "checkpoint")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
