from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from zoneflow.session import build_session

    session = build_session(master="local[*]", **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('checkpoints')}"})
    yield session
    session.stop()


@pytest.fixture
def scratch(spark, request):
    from zoneflow.session import scratch_dir

    return scratch_dir(spark, f"test-{request.node.name[:40]}")
