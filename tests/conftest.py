from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from grantlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "grantlens-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.checkpoint.dir": f"file:{folder}"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
