import datetime as dt
import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
# Python workers (grouped-map tests) import the package and the test helpers by name.
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH", "")) if p)

from headroom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, "headroom-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


def day(i: int, start: str = "2025-01-01") -> dt.datetime:
    return dt.datetime.fromisoformat(start) + dt.timedelta(days=i)


def hour(i: int, start: str = "2025-01-01") -> dt.datetime:
    return dt.datetime.fromisoformat(start) + dt.timedelta(hours=i)


def d(i: int, start: str = "2025-01-01") -> dt.date:
    return (dt.datetime.fromisoformat(start) + dt.timedelta(days=i)).date()
