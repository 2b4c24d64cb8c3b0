import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventpipe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def topic(spark):
    """Records from JSON lines; offsets count up, the record time is one fixed second."""
    import datetime as dt

    from eventpipe.schemas import TOPIC

    def build(*values, start=0, partition=0):
        at = dt.datetime(2024, 3, 1, 12, 0, tzinfo=dt.timezone.utc)
        rows = [(None, v, "events", partition, start + i, at) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, TOPIC)

    return build
