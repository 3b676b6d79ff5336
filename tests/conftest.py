from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tessera.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tessera-tests",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
        master="local[8]",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
