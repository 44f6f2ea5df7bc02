from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from known import AS_OF, CALENDAR, ROWS  # noqa: E402

from tradeloom.operators.silver import JOBS  # noqa: E402
from tradeloom.plans.layers import Layers  # noqa: E402
from tradeloom.session import local_session  # noqa: E402
from tradeloom.sources.schemas import SOURCES  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def raw(spark):
    frames = {}
    for table, rows in ROWS.items():
        names = SOURCES[table].fieldNames()
        schema = ", ".join(f"{n} string" for n in names)
        frames[table] = spark.createDataFrame(
            [tuple(row.get(n) for n in names) for row in rows], schema
        )
    return frames


@pytest.fixture(scope="session")
def layers(spark, raw):
    assert set(raw) == set(JOBS)
    return Layers(spark, raw, AS_OF, CALENDAR)


@pytest.fixture(scope="session")
def tiny():
    folder = pathlib.Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("driver tables are not here")
    return str(folder)
