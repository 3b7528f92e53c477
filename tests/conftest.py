from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from servstar.session import build_session
    scratch = tempfile.mkdtemp(prefix="servstar-test-")
    s = build_session("local[4]", app="servstar-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": f"{scratch}/checkpoints"})
    yield s
    s.stop()
