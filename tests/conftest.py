from __future__ import annotations

import os
import sys
import datetime as dt

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from musterline.model import ROSTER_SCHEMA  # noqa: E402
from musterline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def roster(spark):
    """A frame of roster rows from (id, department, designation, salary, date, score)."""

    def build(*rows, names=None):
        data = [
            (
                row[0],
                names[i] if names else f"Person {i}",
                row[1],
                row[2],
                float(row[3]) if row[3] is not None else None,
                dt.date.fromisoformat(row[4]),
                row[5],
                i,
            )
            for i, row in enumerate(rows)
        ]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ROSTER_SCHEMA)
        return spark.createDataFrame(data, schema + ", ordinal bigint")

    return build
