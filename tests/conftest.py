from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from telemetra.session import build_session
    s = build_session("local[4]", 4, app_name="telemetra-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="telemetra-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
