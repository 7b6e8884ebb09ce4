from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from corpuskit.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{TESTDATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("the given tables are not here")
    return path
