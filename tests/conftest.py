from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from rillmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "rillmart-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Rows of JSON text, from dicts or raw strings."""

    def make(*records):
        texts = [r if isinstance(r, str) or r is None else json.dumps(r) for r in records]
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "version BIGINT, value STRING")

    return make
