import os
import sys
import time

import pytest

os.environ["TZ"] = "UTC"
time.tzset()
sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from lapwright.session import local_session  # noqa: E402
from lapwright.plans.catalog import derived_tables  # noqa: E402
from lapwright.schemas import TABLES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", partitions=4, memory="4g")


@pytest.fixture
def racing(spark):
    """Tables over hand-written raw rows, given as endpoint -> list of dicts; others are empty."""

    def build(**rows):
        frames = {}
        for endpoint, spec in TABLES.items():
            values = [tuple(r.get(c) for c in spec.schema.names) for r in rows.get(endpoint, [])]
            frames[endpoint] = spark.createDataFrame(values, spec.schema)
        return derived_tables(frames)

    return build


def rows(df, *columns):
    """Rows as plain tuples, in a fixed order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
