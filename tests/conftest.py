import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from transitlens.schemas import REF_LINES, REF_STATIONS  # noqa: E402
from transitlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="transitlens-test-")
    s = build_session("local[*]", 8, "transitlens-tests", {"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_stations(spark):
    # FIXTURES.md §3: three stations on line x, one 'Oval Station' on line y.
    return spark.createDataFrame([
        ("A1", "Acton Town Station", "x", 51.0, -0.1),
        ("E1", "East Acton Station", "x", 51.2, -0.3),
        ("O1", "Oval Station", "x", 51.4, -0.5),
        ("O2", "Oval Station", "y", 50.0, 0.0),
    ], REF_STATIONS)


@pytest.fixture(scope="session")
def fixture_lines(spark):
    return spark.createDataFrame([
        ("x", "X Line", "#B36305", 179, 99, 5),
        ("y", "Y Line", "#E32017", 227, 32, 23),
    ], REF_LINES)
