from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from creditweave.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("8")


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="creditweave-test-")


def rows(df, *order):
    """Rows as dicts, in a fixed order."""
    return [r.asDict() for r in df.orderBy(*order).collect()]
