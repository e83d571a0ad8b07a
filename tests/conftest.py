from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from waveband.session import ensure_checkpoint_dir, get_session

    session = get_session("local[4]", app_name="waveband-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused or cleared)."""
    return tempfile.mkdtemp(prefix="waveband-test-")
