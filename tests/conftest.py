from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from retailflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "retailflow-tests", master="local[4]", shuffle_partitions=4,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.session.timeZone": "Asia/Shanghai",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="retailflow-ckpt-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="retailflow-wh-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
