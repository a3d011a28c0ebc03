import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillcast.session import local_session  # noqa: E402

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture()
def hours():
    """Timestamp of an hour offset."""
    return lambda h: START + dt.timedelta(hours=h)


@pytest.fixture()
def obs(spark):
    """Observations of one series from ``{hour offset: value}``."""

    def build(values, site=1, code="Discharge", variable_id=1, first_id=1, start=START):
        rows = [
            (first_id + i, start + dt.timedelta(hours=h), site, code, variable_id, v)
            for i, (h, v) in enumerate(values.items())
        ]
        return spark.createDataFrame(
            rows,
            "datastream_id long, datetime_utc timestamp_ntz, site_id int, variable_code string, "
            "variable_id int, value double",
        )

    return build
