from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tradestar.session import build_session

    # tests set their own checkpoint folder (a session on a cluster reads it from spark.checkpoint.dir)
    session = build_session(
        master="local[4]",
        app_name="tradestar-tests",
        shuffle_partitions=8,
        checkpoint_dir=tempfile.mkdtemp(prefix="tradestar-test-ckpt-"),
        extra={"spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tradestar-test-")
